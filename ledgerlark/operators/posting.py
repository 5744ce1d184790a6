"""Posting a batch of sale requests against the stock.

Requests are decided as if one came after the other. A product's stock admits a
request if what is left covers it; a refused request leaves the stock to later ones,
so a plain running sum is not enough. The requests of a product are folded in order where
they are few. A product with more than ``FOLD`` of them is decided in rounds, without
gathering its requests in one task. With R left of a product, a request is light up to half of
R and heavy beyond. A running sum of the light ones finds the first heavy request that
still fits, or the first light one that takes the sum past half of R. Before it every
light request is admitted and every heavy one refused; it is admitted itself, and what is
left then is at most half of R. So there are at most as many rounds as the largest
stock has binary digits, and one more, however many requests there are.

A transaction number is taken by the first request that is admitted under it, and a
request refused for the stock frees it again. That couples the products: whether a
request behind the first of its number may claim it hangs on requests for other products,
and those on claims in turn. The claims are found in passes. A pass decides the products
with the claims supposed so far, and notes for every request what would become of it if
the claim ahead of it in its product were the other way round. So each claim follows from one
other claim by a function of a single truth value, and composing these functions, two links
at a time, settles chains of any length in logarithmically many joins. The next pass
supposes the claims found. What a pass decides is final at least up to the first claim
that was wrong, and a pass that finds the claims it supposed ends the search.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.joins import keyed_once, resolve_by
from ledgerlark.operators.ordering import number_rows, part_numbers, running_total
from ledgerlark.session import alone, discard, materialise, materialise_pieces, sparing

#: Requests of one product that are folded in one task; more of them are decided in rounds.
FOLD = 1000


def _round(pending: DataFrame) -> DataFrame:
    """Pending requests with their verdict, or with what is left if they stay pending."""
    light = 2 * F.col("quantity") <= F.col("rest")
    weighed = pending.withColumn("_light", F.when(light, F.col("quantity")).otherwise(0))
    summed = running_total(weighed, ["product"], ["seq"], "_light", "_sum", part="part")
    before = F.col("rest") - F.col("_sum") + F.col("_light")
    turns = F.when(light, 2 * F.col("_sum") > F.col("rest")).otherwise(F.col("quantity") <= before)
    turn = summed.where(turns).groupBy("product").agg(
        F.min(F.struct("seq", (before - F.col("quantity")).alias("left"))).alias("turn")
    )
    decided = F.col("turn").isNull() | (F.col("seq") <= F.col("turn.seq"))
    admitted = light | F.coalesce(F.col("seq") == F.col("turn.seq"), F.lit(False))
    joined = summed.join(turn, "product", "left").select(
        "product", "seq", "quantity", "part",
        F.when(decided, admitted).when(F.col("quantity") > F.col("turn.left"), False).alias("admitted"),
        F.col("turn.left").alias("rest"),
    )
    return materialise(joined)


def admit_in_order(requests: DataFrame, product: str, seq: str, quantity: str, stock: str) -> DataFrame:
    """Each request, by product and ``seq``, with its verdict ``admitted``.

    ``quantity`` is positive, ``stock`` the same in all rows of a product, and
    ``seq`` unique. Only these four columns are moved.
    """
    narrow = requests.select(
        F.col(product).alias("product"),
        F.col(seq).cast("bigint").alias("seq"),
        F.col(quantity).cast("bigint").alias("quantity"),
        F.col(stock).cast("bigint").alias("rest"),
    )
    verdicts = [narrow.where(F.col("quantity") > F.col("rest")).select("product", "seq", F.lit(False).alias("admitted"))]
    pending = narrow.where(F.col("quantity") <= F.col("rest"))
    # The parts of the running totals are cut once for all rounds.
    pending = pending.withColumn("part", part_numbers(pending, ["product"], ["seq"]))
    while not pending.isEmpty():
        judged = _round(pending)
        verdicts.append(judged.where(F.col("admitted").isNotNull()).select("product", "seq", "admitted"))
        pending = judged.where(F.col("admitted").isNull()).drop("admitted")
    return reduce(DataFrame.unionByName, verdicts).select(
        F.col("product").alias(product), F.col("seq").alias(seq), "admitted"
    )


#: What is known of a request when its product is decided with the claims supposed: whether
#: it is ``admitted``; whether there is ``room`` for it, claim or not; the claim in doubt
#: ``ahead`` of it in its product, if any; that claim as supposed; and whether it would be
#: admitted if that claim were the ``other`` way round.
_FATE = "seq bigint, claims boolean, admitted boolean, room boolean, ahead bigint, ahead_claims boolean, other boolean"


def _fold(requests: DataFrame) -> DataFrame:
    """Fates of the requests of products that have few, each product in one fold."""
    grouped = requests.groupBy("product").agg(
        F.max("stock").alias("stock"),
        F.array_sort(F.collect_list(F.struct("seq", "quantity", "claims", "doubtful"))).alias("in_order"),
    )

    def sold(flag: Column, request: Column) -> Column:
        return F.when(flag, request["quantity"]).otherwise(F.lit(0))

    def step(state: Column, request: Column) -> Column:
        room = request["quantity"] <= state["rest"]
        admitted = request["claims"] & room
        other = F.when(state["ahead"].isNull(), admitted).otherwise(
            request["claims"] & (request["quantity"] <= state["other_rest"])
        )
        fate = F.struct(
            request["seq"].alias("seq"), request["claims"].alias("claims"), admitted.alias("admitted"),
            room.alias("room"), state["ahead"].alias("ahead"), state["ahead_claims"].alias("ahead_claims"),
            other.alias("other"),
        )
        return F.struct(
            (state["rest"] - sold(admitted, request)).alias("rest"),
            F.when(request["doubtful"], state["rest"] - sold(~request["claims"] & room, request))
            .otherwise(state["other_rest"] - sold(other, request)).alias("other_rest"),
            F.when(request["doubtful"], request["seq"]).otherwise(state["ahead"]).alias("ahead"),
            F.when(request["doubtful"], request["claims"]).otherwise(state["ahead_claims"]).alias("ahead_claims"),
            F.concat(state["fates"], F.array(fate)).alias("fates"),
        )

    start = F.struct(
        F.col("stock").alias("rest"),
        F.lit(None).cast("bigint").alias("other_rest"),
        F.lit(None).cast("bigint").alias("ahead"),
        F.lit(None).cast("boolean").alias("ahead_claims"),
        F.array().cast(f"array<struct<{_FATE.replace(' bigint', ':bigint').replace(' boolean', ':boolean')}>>").alias("fates"),
    )
    folded = grouped.select("product", F.aggregate("in_order", start, step)["fates"].alias("fates"))
    return folded.select("product", F.inline("fates"))


def _rounds(requests: DataFrame) -> DataFrame:
    """Fates of the requests of products that have many; see ``admit_in_order``."""
    verdicts = admit_in_order(requests.where("claims"), "product", "seq", "quantity", "stock")
    rows = materialise(
        requests.join(verdicts, ["product", "seq"], "left")
        .withColumn("admitted", F.coalesce("admitted", F.lit(False)))
        .withColumn("sold", F.when(F.col("admitted"), F.col("quantity")).otherwise(0))
        .withColumn("one", F.col("doubtful").cast("bigint"))
    )
    part = part_numbers(rows, ["product"], ["seq"])
    rows = running_total(rows.withColumn("part", part), ["product"], ["seq"], "sold", "upto", part="part")
    rows = running_total(rows, ["product"], ["seq"], "one", "segment", part="part")
    rows = materialise(
        rows.withColumn("rest", F.col("stock") - F.col("upto") + F.col("sold"))
        .withColumn("room", F.col("quantity") <= F.col("rest"))
        .withColumn("segment", F.col("segment") - F.col("one"))
    )
    # What would be left behind each doubtful claim if it were the other way round.
    heads = rows.where("doubtful").select(
        "product", (F.col("segment") + 1).alias("segment"), F.col("seq").alias("ahead"),
        F.col("claims").alias("ahead_claims"),
        (F.col("rest") - F.when(~F.col("claims") & F.col("room"), F.col("quantity")).otherwise(0)).alias("other_rest"),
    )
    rows = materialise(rows.join(heads, ["product", "segment"], "left"))
    others = admit_in_order(
        rows.where(F.col("claims") & F.col("ahead").isNotNull()), "ahead", "seq", "quantity", "other_rest"
    ).select("seq", F.col("admitted").alias("other"))
    other = F.when(F.col("ahead").isNull(), F.col("admitted")).otherwise(F.coalesce("other", F.lit(False)))
    return rows.join(others, "seq", "left").withColumn("other", other).select(
        "product", "seq", "claims", "admitted", "room", "ahead", "ahead_claims", "other"
    )


def _fates(requests: DataFrame, any_large: bool) -> DataFrame:
    few = _fold(requests.where(~F.col("large")))
    return few.unionByName(_rounds(requests.where("large"))) if any_large else few


def _links(state: DataFrame) -> DataFrame:
    """Each doubtful claim as a function of one other: ``f0`` is what it is if the claim
    ``parent`` is not there, ``f1`` if it is; without a parent both are what is found.

    ``state`` holds the fates of all requests that share a number, with ``number`` and
    ``doubtful``. A claim falls with the first request admitted under its number; where
    there is none so far, it would fall with the first that could be.
    """
    own = F.col("doubtful") & F.col("room")
    could = ~F.col("admitted") & (own | (F.col("claims") & F.col("other")))
    numbers = state.groupBy("number").agg(
        F.min(F.when(F.col("admitted"), F.col("seq"))).alias("holder"),
        F.min(F.when(could, F.col("seq"))).alias("maybe"),
    )
    claims = state.where("doubtful").select("seq", "product", "number").join(numbers, "number")
    held = F.coalesce(F.col("holder") < F.col("seq"), F.lit(False))
    claims = claims.select(
        "seq", "product", (~held).alias("found"),
        F.when(held, F.col("holder")).when(F.col("maybe") < F.col("seq"), F.col("maybe")).alias("rival"),
    )
    rivals = state.select(
        F.col("seq").alias("rival"), own.alias("own"), "ahead", "ahead_claims", "other"
    )
    joined = claims.join(rivals, "rival", "left")
    parent = F.when(F.col("own"), F.col("rival")).otherwise(F.col("ahead"))
    # The claim if its parent is as supposed, and if it is the other way round.
    same, turned = F.col("found"), ~F.col("other")
    f0 = F.when(F.col("own"), True).when(F.col("ahead_claims"), turned).otherwise(same)
    f1 = F.when(F.col("own"), False).when(F.col("ahead_claims"), same).otherwise(turned)
    linked = joined.select(
        "seq", "product", "found", parent.alias("parent"),
        F.coalesce(f0, F.col("found")).alias("f0"), F.coalesce(f1, F.col("found")).alias("f1"),
    )
    settled = F.col("parent").isNull() | (F.col("f0") == F.col("f1"))
    return linked.select(
        "seq", "product", "found",
        F.when(~settled, F.col("parent")).alias("parent"),
        F.when(F.col("parent").isNull(), F.col("found")).otherwise(F.col("f0")).alias("f0"),
        F.when(F.col("parent").isNull(), F.col("found")).otherwise(F.col("f1")).alias("f1"),
    )


def _composed(links: DataFrame) -> DataFrame:
    """All claims as truth values ``claims``: every step puts a parent's own function in place of
    the parent, so a chain of n links is settled in about log2(n) steps. Only claims that are
    not settled yet are carried from step to step; ``links`` is a written table."""
    settled = [links.where(F.col("parent").isNull()).drop("found")]
    moving = links.where(F.col("parent").isNotNull()).drop("found")
    while not moving.isEmpty():
        known = reduce(DataFrame.unionByName, settled).unionByName(moving)
        above = known.select(
            F.col("seq").alias("parent"), F.col("parent").alias("next"), F.col("f0").alias("p0"), F.col("f1").alias("p1")
        )

        def through(value: str) -> Column:
            return F.when(F.col(value), F.col("f1")).otherwise(F.col("f0"))

        stepped = moving.join(above, "parent").select(
            "seq", "product", "next", through("p0").alias("f0"), through("p1").alias("f1")
        )
        stepped = materialise(
            stepped.select(
                "seq", "product", F.when(F.col("f0") != F.col("f1"), F.col("next")).alias("parent"), "f0", "f1"
            )
        )
        settled.append(stepped.where(F.col("parent").isNull()))
        moving = stepped.where(F.col("parent").isNotNull())
    return reduce(DataFrame.unionByName, settled).select("seq", "product", F.col("f0").alias("claims"))


def admit_with_numbers(requests: DataFrame) -> DataFrame:
    """Each request by ``seq`` with ``claims``, whether its number was still free, and
    ``admitted``, whether the stock covered it if so.

    requests ``(seq, number, product_id, quantity, stock)``, all of them valid but
    for number and stock.
    """
    narrow = requests.select(
        F.col("seq").cast("bigint").alias("seq"), "number", F.col("product_id").alias("product"),
        F.col("quantity").cast("bigint").alias("quantity"), F.col("stock").cast("bigint").alias("stock"),
    )
    # Both are written by themselves, so that their shuffles are gone when all requests are shuffled.
    shared = narrow.groupBy("number").agg(F.count("*").alias("_n"), F.min("seq").alias("_first"))
    shared = materialise(shared.where(F.col("_n") > 1).drop("_n"))
    many = narrow.groupBy("product").agg(F.count("*").alias("_n")).where(F.col("_n") > FOLD)
    many = materialise(many.select("product", F.lit(True).alias("large")))
    flagged = narrow.join(shared, "number", "left").join(many, "product", "left")
    flagged = materialise(
        flagged.select(
            "seq", "number", "product", "quantity", "stock",
            F.coalesce("large", F.lit(False)).alias("large"),
            F.col("_first").isNotNull().alias("shares"),
            F.coalesce(F.col("seq") > F.col("_first"), F.lit(False)).alias("doubtful"),
        )
    )
    discard(shared, many)
    any_large = not flagged.where("large").isEmpty()
    rivals = flagged.where("shares").select("seq", "number", "doubtful")
    # At first the first request under each number is supposed to get it.
    claims = flagged.where("doubtful").select("seq", "product", F.lit(False).alias("claims"))
    open_now, verdicts, touched, state = flagged, [], [], None
    while True:
        supposed = claims.select("seq", F.col("claims").alias("_claims"))
        open_now = open_now.join(supposed, "seq", "left").withColumn("claims", F.coalesce("_claims", F.lit(True)))
        fresh = alone(lambda: materialise(_fates(open_now, any_large)))
        verdicts.append(fresh.select("product", "seq", "claims", "admitted"))
        state_now = fresh.join(rivals, "seq")
        if state is not None:
            state_now = state_now.unionByName(state.join(touched[-1], "product", "left_anti"))
        before, state = state, materialise(state_now)
        discard(before)
        links = materialise(_links(state))
        if links.join(supposed, "seq").where(F.col("found") != F.col("_claims")).isEmpty():
            break
        before, claims = claims, alone(lambda: materialise(_composed(links)))
        discard(links)
        wrong = claims.join(supposed, "seq").where(F.col("claims") != F.col("_claims"))
        touched.append(materialise(wrong.select("product").distinct()))
        discard(before)
        open_now = flagged.join(touched[-1], "product", "left_semi")
    # The last verdict on each product holds.
    last = []
    for i, verdict in enumerate(verdicts):
        for later in touched[i:]:
            verdict = verdict.join(later, "product", "left_anti")
        last.append(verdict.select("seq", "claims", "admitted"))
    return reduce(DataFrame.unionByName, last)


class Posting(NamedTuple):
    decided: DataFrame
    headers: DataFrame
    lines: DataFrame
    stock: DataFrame


def _slices(df: DataFrame, ends: list[int]) -> list[DataFrame]:
    """The rows up to each of ``ends`` by ``seq``, and those behind the last; without a ``seq`` rows are in the first."""
    if not ends:
        return [df]
    seq = F.col("seq")
    first, last = seq.isNull() | (seq <= ends[0]), seq > ends[-1]
    between = [(seq > low) & (seq <= high) for low, high in zip(ends, ends[1:])]
    return [df.where(condition) for condition in (first, *between, last)]


def check_sales(
    requests: DataFrame,
    customers: DataFrame,
    employees: DataFrame,
    products: DataFrame,
    posted: DataFrame,
    ends: list[int],
) -> DataFrame:
    """Every request with what it was resolved to, the stock, and the ``reason`` of its refusal, if it is
    refused whatever becomes of others. Arguments are those of ``decide_sales``, the result is a written table."""
    # Each lookup is brought to a row per key once for all slices.
    customers = materialise(keyed_once(customers, ["email"], ["customer_id"]))
    employees = materialise(keyed_once(employees, ["email"], ["employee_id"]))
    products = materialise(
        keyed_once(products, ["brand_name", "model_name"], ["product_id", "unit_price", "stock_quantity"])
    )
    used = materialise(posted.select("transaction_number").distinct().withColumn("_used", F.lit(True)))
    reason = (
        F.when(F.col("customer_id").isNull(), F.lit("customer not found"))
        .when(F.col("employee_id").isNull(), F.lit("employee not found"))
        .when(F.col("product_id").isNull(), F.lit("product not found"))
        .when(
            F.col("quantity").isNull() | (F.col("quantity") <= 0),
            F.lit("quantity must be greater than zero"),
        )
        .when(F.col("transaction_number").isNull(), F.lit("transaction number is missing"))
        .when(F.col("_used"), F.lit("transaction number already exists"))
    )

    def check(requests: DataFrame) -> DataFrame:
        resolved = resolve_by(requests, customers, ["customer_email"], "left")
        resolved = resolve_by(resolved, employees, ["employee_email"], "left")
        resolved = resolve_by(resolved, products, ["brand_name", "model_name"], "left")
        return resolved.join(used, "transaction_number", "left").select(
            "seq",
            "transaction_number",
            "transaction_date",
            "customer_id",
            "employee_id",
            "product_id",
            "quantity",
            "unit_price",
            "stock_quantity",
            reason.alias("reason"),
        )

    # The lookups are run once; the decisions read their result.
    return materialise_pieces(check(piece) for piece in _slices(requests, ends))


def decide_checked(checked: DataFrame, ends: list[int]) -> DataFrame:
    """The decision on what ``check_sales`` gives, a written table."""
    open_requests = checked.where(F.col("reason").isNull()).select(
        "seq", F.col("transaction_number").alias("number"), "product_id", "quantity",
        F.col("stock_quantity").alias("stock"),
    )
    admitted = alone(lambda: materialise(admit_with_numbers(open_requests)))

    def decide(checked: DataFrame, admitted: DataFrame) -> DataFrame:
        decided = checked.join(admitted, "seq", "left").withColumn(
            "reason",
            F.when(F.col("reason").isNotNull(), F.col("reason"))
            .when(~F.col("claims"), F.lit("transaction number already exists"))
            .when(~F.col("admitted"), F.lit("not enough stock")),
        )
        return decided.drop("claims", "admitted", "stock_quantity")

    return materialise_pieces(map(decide, _slices(checked, ends), _slices(admitted, ends)))


def decide_sales(
    requests: DataFrame,
    customers: DataFrame,
    employees: DataFrame,
    products: DataFrame,
    posted: DataFrame,
    ends: list[int] | None = None,
) -> DataFrame:
    """Every request with what it was resolved to and the ``reason`` of its refusal, if any.

    Arguments are those of ``post_sales``. The result is a written table. ``ends`` cuts the requests
    behind these values of ``seq``, ascending: the lookups and the writing of the result then move
    one slice of the requests at a time, and their shuffles take the disk of a slice. ``requests``
    are read once a slice, so their ``seq`` must not change in between. Tables written on the way
    are deleted.
    """
    ends = ends or []
    with sparing(requests.sparkSession):
        return alone(lambda: decide_checked(
            alone(lambda: check_sales(requests, customers, employees, products, posted, ends)), ends
        ))


def accepted_sales(decided: DataFrame, last_id: int | Column = 0) -> DataFrame:
    """The accepted requests of a written decision, numbered in the order of ``seq`` behind ``last_id``."""
    accepted = decided.where(F.col("reason").isNull())
    with sparing(decided.sparkSession):
        return materialise(number_rows(accepted, [F.col("seq")], "sales_transaction_id", last_id, unique=True))


def post_decided(
    decided: DataFrame,
    accepted: DataFrame,
    products: DataFrame,
    today: Column | None = None,
    status: str = "pending",
    payment: str = "card",
) -> Posting:
    """What a decision (see ``decide_sales`` and ``accepted_sales``) posts.

    A request without a date gets ``today``, and ``status`` and ``payment`` are those of
    all headers.
    """
    headers = accepted.select(
        "sales_transaction_id",
        "transaction_number",
        "customer_id",
        "employee_id",
        F.coalesce("transaction_date", F.current_date() if today is None else today).alias("transaction_date"),
        F.lit(status).alias("transaction_status"),
        F.lit(payment).alias("payment_method"),
    )
    lines = accepted.select(
        "sales_transaction_id", "transaction_number", "product_id", "quantity", "unit_price"
    ).withColumn("line_total", (F.col("quantity") * F.col("unit_price")).cast("decimal(12,2)"))
    sold = accepted.groupBy("product_id").agg(F.sum("quantity").alias("_sold"))
    stock = (
        products.join(sold, "product_id", "left")
        .withColumn("stock_quantity", F.col("stock_quantity") - F.coalesce("_sold", F.lit(0)))
        .drop("_sold")
    )
    return Posting(decided, headers, lines, stock)


def post_sales(
    requests: DataFrame,
    customers: DataFrame,
    employees: DataFrame,
    products: DataFrame,
    posted: DataFrame,
    last_id: int | Column = 0,
    today: Column | None = None,
    status: str = "pending",
    payment: str = "card",
) -> Posting:
    """Decide on sale requests, in the order of ``seq``, and post those that are accepted.

    requests ``(seq, transaction_number, customer_email, employee_email,
    brand_name, model_name, quantity, transaction_date)``; customers
    ``(customer_id, email)``; employees ``(employee_id, email)``; products
    ``(product_id, brand_name, model_name, unit_price, stock_quantity)``;
    posted ``(transaction_number)``.

    A number is taken by a posted sale, or by the first request that is posted
    under it. All outputs follow from one decision, which is made before this returns.
    """
    decided = decide_sales(requests, customers, employees, products, posted)
    return post_decided(decided, accepted_sales(decided, last_id), products, today, status, payment)
