"""Sale posting against a plain loop."""

import os
import random
import time
from datetime import date
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlark.operators import posting as posting_operator
from ledgerlark.operators.posting import admit_in_order, post_sales
from tests.conftest import bag


def admitted_by_loop(requests):
    """requests (product, seq, quantity, stock) -> set of admitted seqs."""
    left, taken = {}, set()
    for product, seq, quantity, stock in sorted(requests, key=lambda r: r[1]):
        left.setdefault(product, stock)
        if quantity <= left[product]:
            left[product] -= quantity
            taken.add(seq)
    return taken


def admitted_by_spark(spark, requests):
    df = spark.createDataFrame(requests, "product long, seq long, quantity int, stock int")
    result = admit_in_order(df, "product", "seq", "quantity", "stock")
    assert result.count() == len(requests)
    return {row.seq for row in result.where("admitted").collect()}


@pytest.mark.parametrize("seed", range(4))
def test_hot_product(spark, conf, seed):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    rng = random.Random(seed)
    stocks = {p: rng.choice([0, 1, 7, 60, 5000]) for p in range(30)}
    stocks[0] = rng.choice([3, 400, 20000])
    requests = []
    for seq in range(2500):
        product = 0 if rng.random() < 0.4 else rng.randrange(30)
        requests.append((product, seq, rng.randrange(1, 51), stocks[product]))
    rng.shuffle(requests)
    assert admitted_by_spark(spark, requests) == admitted_by_loop(requests)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(1, 9)), min_size=1, max_size=40), st.integers(0, 25))
def test_any_order_of_quantities(spark, lines, stock):
    requests = [(p, i, q, stock + p) for i, (p, q) in enumerate(lines)]
    assert admitted_by_spark(spark, requests) == admitted_by_loop(requests)


def test_large_quantities_take_more_rounds(spark):
    """Misfits of any size."""
    rng = random.Random(5)
    requests = [(p, i, rng.choice([1, 2, 5, 40, 900, 10**6]), 10**6 + p * 7) for i, p in
                enumerate(rng.randrange(3) for _ in range(120))]
    requests.insert(0, (0, 1000, 2 * 10**6, 10**6))
    assert admitted_by_spark(spark, requests) == admitted_by_loop(requests)


def test_rounds_follow_the_stock_and_not_the_requests(spark, monkeypatch):
    """Quantities 1, S, 1, S - 1, 1, S - 2 ...: each refused by one unit."""
    rounds = []
    original = posting_operator._round
    monkeypatch.setattr(posting_operator, "_round", lambda pending: rounds.append(1) or original(pending))
    stock = 1000
    requests = []
    for i in range(1200):
        requests += [(1, 2 * i, 1, stock), (1, 2 * i + 1, max(1, stock - i), stock)]
    assert admitted_by_spark(spark, requests) == admitted_by_loop(requests)
    assert len(rounds) <= stock.bit_length() + 1


def posted_by_loop(requests):
    """(seq, number, product, quantity, stock) -> (claims, admitted) of each, one by one."""
    left, taken, out = {}, set(), {}
    for seq, number, product, quantity, stock in sorted(requests):
        left.setdefault(product, stock)
        claims = number not in taken
        admitted = claims and quantity <= left[product]
        if admitted:
            left[product] -= quantity
            taken.add(number)
        out[seq] = (claims, admitted)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_numbers_are_freed_by_refusals(spark, seed):
    rng = random.Random(seed)
    stocks = [rng.choice([0, 3, 10, 40]) for _ in range(6)]
    requests = []
    for seq in range(150):
        product = rng.randrange(6)
        requests.append((seq, f"N{rng.randrange(60)}", product, rng.randrange(1, 12), stocks[product]))
    df = spark.createDataFrame(requests, "seq long, number string, product_id long, quantity int, stock int")
    got = {r.seq: (r.claims, r.admitted) for r in posting_operator.admit_with_numbers(df).collect()}
    assert got == posted_by_loop(requests)


def test_registered_query_equals_a_loop(spark):
    """The requests of the given tables, decided one by one."""
    from ledgerlark.plans.catalog import QUERIES
    from tests.conftest import SMALL

    rows = QUERIES["post_sales"](spark, SMALL).collect()
    stocks = {r.p_partkey: r.p_size * 10 for r in spark.read.parquet(f"{SMALL}/part.parquet").collect()}
    final = ("not enough stock", "transaction number already exists", None)
    posted = {f"TX-{r.o_orderkey}-1" for r in
              spark.read.parquet(f"{SMALL}/orders.parquet").where("o_orderstatus = 'P'").collect()}
    tried = [(r.seq, r.transaction_number, r.product_id, r.quantity, stocks[r.product_id]) for r in rows
             if r.reason in final and r.transaction_number not in posted]
    want = posted_by_loop(tried)
    for r in rows:
        if r.seq in want:
            claims, admitted = want[r.seq]
            assert r.reason == (None if admitted else final[0] if claims else final[1])
    assert sum(r.reason is None for r in rows) > 100


def test_later_request_fits_because_an_earlier_one_was_rejected(spark):
    requests = [(1, 1, 6, 10), (1, 2, 5, 10), (1, 3, 4, 10), (1, 4, 1, 10)]
    assert admitted_by_spark(spark, requests) == {1, 3}


@pytest.fixture(scope="module")
def posting(spark):
    requests = spark.createDataFrame(
        [
            (1, "T1", " ADA@x.org ", "mia@x.org", " Samsung", "RB34 ", 3, date(2026, 1, 1)),
            (2, "T2", "nobody@x.org", "mia@x.org", "samsung", "rb34", 1, date(2026, 1, 1)),
            (3, "T3", "ada@x.org", None, "samsung", "rb34", 1, date(2026, 1, 1)),
            (4, "T4", "ada@x.org", "mia@x.org", "samsung", "f2v", 1, date(2026, 1, 1)),
            (5, "T5", "ada@x.org", "mia@x.org", "samsung", "rb34", 0, date(2026, 1, 1)),
            (6, "T6", "ada@x.org", "mia@x.org", "samsung", "rb34", None, date(2026, 1, 1)),
            (7, "OLD", "ada@x.org", "mia@x.org", "samsung", "rb34", 1, date(2026, 1, 1)),
            (8, "T1", "ada@x.org", "mia@x.org", "lg", "f2v", 1, date(2026, 1, 2)),
            (9, "T9", "ada@x.org", "mia@x.org", "samsung", "rb34", 6, date(2026, 1, 2)),
            (10, "T10", "ada@x.org", "mia@x.org", "samsung", "rb34", 5, date(2026, 1, 2)),
            (11, "T2", "ada@x.org", "mia@x.org", "lg", "f2v", 2, date(2026, 1, 2)),
            (12, None, "ada@x.org", "mia@x.org", "lg", "f2v", 1, date(2026, 1, 2)),
            (13, None, "ada@x.org", "mia@x.org", "lg", "f2v", 1, date(2026, 1, 2)),
            (14, "T9", "ada@x.org", "mia@x.org", "lg", "f2v", 1, None),
            (15, "T9", "ada@x.org", "mia@x.org", "lg", "f2v", 1, date(2026, 1, 2)),
        ],
        "seq long, transaction_number string, customer_email string, employee_email string,"
        " brand_name string, model_name string, quantity int, transaction_date date",
    )
    customers = spark.createDataFrame([(1, "ada@x.org")], "customer_id long, email string")
    employees = spark.createDataFrame([(7, "mia@x.org")], "employee_id long, email string")
    products = spark.createDataFrame(
        [
            (1, "samsung", "rb34", Decimal("1899.00"), 8),
            (2, "lg", "f2v", Decimal("1499.99"), 10),
            (3, "bosch", "sms", Decimal("1.00"), 4),
        ],
        "product_id long, brand_name string, model_name string, unit_price decimal(10,2), stock_quantity int",
    )
    posted = spark.createDataFrame([("OLD",)], "transaction_number string")
    return post_sales(
        requests, customers, employees, products, posted, last_id=40, today=F.lit(date(2026, 2, 2))
    )


def test_reject_reasons(posting):
    assert bag(posting.decided.select("seq", "reason")) == sorted(
        [
            (1, None),
            (2, "customer not found"),
            (3, "employee not found"),
            (4, "product not found"),
            (5, "quantity must be greater than zero"),
            (6, "quantity must be greater than zero"),
            (7, "transaction number already exists"),
            (8, "transaction number already exists"),
            (9, "not enough stock"),
            (10, None),
            (11, None),
            (12, "transaction number is missing"),
            (13, "transaction number is missing"),
            (14, None),
            (15, "transaction number already exists"),
        ],
        key=repr,
    )


def test_headers_lines_and_stock_agree(posting):
    day = date(2026, 1, 2)
    assert bag(posting.headers) == [
        (41, "T1", 1, 7, date(2026, 1, 1), "pending", "card"),
        (42, "T10", 1, 7, day, "pending", "card"),
        (43, "T2", 1, 7, day, "pending", "card"),
        (44, "T9", 1, 7, date(2026, 2, 2), "pending", "card"),
    ]
    assert bag(posting.lines) == sorted(
        [
            (41, "T1", 1, 3, Decimal("1899.00"), Decimal("5697.00")),
            (42, "T10", 1, 5, Decimal("1899.00"), Decimal("9495.00")),
            (43, "T2", 2, 2, Decimal("1499.99"), Decimal("2999.98")),
            (44, "T9", 2, 1, Decimal("1499.99"), Decimal("1499.99")),
        ],
        key=repr,
    )
    assert bag(posting.stock.select("product_id", "stock_quantity")) == [(1, 0), (2, 7), (3, 4)]


def chain(n):
    """Alternately refused for stock and admitted, each because of the one before."""
    requests = [(0, "N1", 0, 5, 1)]
    for i in range(1, n):
        requests += [(2 * i - 1, f"N{i}", i, 1, 1), (2 * i, f"N{i + 1}", i, 1, 1)]
    return requests


def counted(spark, monkeypatch, requests):
    """The verdicts, and the numbers of passes and of compositions they took."""
    passes, steps = [], []
    fates, materialise = posting_operator._fates, posting_operator.materialise
    monkeypatch.setattr(posting_operator, "_fates", lambda *a: passes.append(1) or fates(*a))
    monkeypatch.setattr(
        posting_operator, "materialise",
        lambda df: (steps.append(1) if "f1" in df.columns else None) or materialise(df),
    )
    df = spark.createDataFrame(requests, "seq long, number string, product_id long, quantity int, stock int")
    got = {r.seq: (r.claims, r.admitted) for r in posting_operator.admit_with_numbers(df).collect()}
    return got, len(passes), len(steps)


@pytest.mark.parametrize("n", [64, 500])
def test_a_chain_of_claims_takes_logarithmic_steps(spark, monkeypatch, n):
    got, passes, steps = counted(spark, monkeypatch, chain(n))
    assert got == posted_by_loop(chain(n))
    assert passes <= 2
    assert steps <= n.bit_length() + 3


@pytest.mark.parametrize("fold, seed", [(0, 0), (1000, 0), (1000, 1)])
def test_fold_and_rounds_agree_on_tangled_claims(spark, monkeypatch, fold, seed):
    """Few products and numbers, so that every claim hangs on many others."""
    monkeypatch.setattr(posting_operator, "FOLD", fold)
    rng = random.Random(seed)
    stocks = [rng.choice([1, 4, 9]) for _ in range(4)]
    requests = []
    for seq in range(40):
        product = rng.randrange(4)
        requests.append((seq, f"N{rng.randrange(9)}", product, rng.randrange(1, 5), stocks[product]))
    got, passes, _ = counted(spark, monkeypatch, requests)
    assert got == posted_by_loop(requests)
    assert passes <= 12


def test_a_number_and_a_product_may_hold_a_third(spark, monkeypatch):
    monkeypatch.setattr(posting_operator, "FOLD", 200)
    rng = random.Random(9)
    requests = []
    for seq in range(500):
        product = 0 if rng.random() < 0.4 else rng.randrange(40)
        number = "HOT" if rng.random() < 0.35 else f"N{rng.randrange(500)}"
        requests.append((seq, number, product, rng.randrange(1, 9), 40))
    got, _, _ = counted(spark, monkeypatch, requests)
    assert got == posted_by_loop(requests)


def test_no_requests(spark):
    df = spark.createDataFrame([], "seq long, number string, product_id long, quantity int, stock int")
    assert posting_operator.admit_with_numbers(df).collect() == []


def test_a_decision_is_written_once_per_version_of_its_input(spark, tmp_path):
    from ledgerlark.session import written_once

    source, built = str(tmp_path / "source"), []

    def build():
        built.append(1)
        return posting_operator.materialise(spark.read.parquet(source).withColumn("twice", F.col("id") * 2))

    spark.range(3).write.parquet(source)
    for _ in range(2):
        assert bag(written_once(spark, "twice", [source], build)) == [(0, 0), (1, 2), (2, 4)]
    assert len(built) == 1
    spark.range(1).write.mode("append").parquet(source)
    assert len(bag(written_once(spark, "twice", [source], build))) == 4
    assert len(built) == 2


def written_tables(spark):
    from ledgerlark.session import shared_dir

    folder = shared_dir(spark).removeprefix("file:")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def shuffle_bytes(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    sizes = {}
    for path in blocks.split("\n"):
        if "shuffle_" in path and os.path.exists(path):
            sizes[path] = os.path.getsize(path)
    return sizes


def many_requests(spark, n):
    rng = random.Random(3)
    rows = [
        (seq, f"N{rng.randrange(n)}", f" C{rng.randrange(9)}@x.org", f"E{rng.randrange(7)}@x.org", f"B{rng.randrange(4)}",
         "m", rng.randrange(0, 9), None)
        for seq in range(n)
    ]
    requests = spark.createDataFrame(
        rows, "seq long, transaction_number string, customer_email string, employee_email string,"
        " brand_name string, model_name string, quantity int, transaction_date date",
    )
    return (
        requests,
        spark.createDataFrame([(i, f"c{i}@x.org") for i in range(8)], "customer_id long, email string"),
        spark.createDataFrame([(i, f"e{i}@x.org") for i in range(6)], "employee_id long, email string"),
        spark.createDataFrame(
            [(i, f"b{i}", "m", Decimal("1.00"), 60) for i in range(3)],
            "product_id long, brand_name string, model_name string, unit_price decimal(10,2), stock_quantity int",
        ),
        spark.createDataFrame([("N3",)], "transaction_number string"),
    )


@pytest.mark.parametrize("fold", [5, 1000])
def test_posting_leaves_no_other_tables_than_its_results(spark, monkeypatch, fold):
    monkeypatch.setattr(posting_operator, "FOLD", fold)
    tables, before = many_requests(spark, 120), written_tables(spark)
    posting = post_sales(*tables)
    assert len(written_tables(spark) - before) == 2
    assert posting.decided.count() == 120 and posting.headers.count() > 5


def test_shuffle_files_are_freed_when_a_table_is_written(spark):
    """Not only when the driver collects garbage; the settings for it are taken back."""
    codec, rng = spark.conf.get("spark.sql.parquet.compression.codec"), random.Random(1)
    rows = [(seq, f"{rng.getrandbits(8000):x}") for seq in range(1000)]
    decided = spark.createDataFrame(rows, "seq long, transaction_number string").withColumn(
        "reason", F.lit(None).cast("string")
    )
    before = shuffle_bytes(spark)
    accepted = posting_operator.accepted_sales(decided)
    for _ in range(40):
        left = sum(size for path, size in shuffle_bytes(spark).items() if path not in before)
        if left < 100_000:
            break
        time.sleep(0.25)
    # What stays is of the sample that cuts the parts: numbers alone, not the 2 MB of the rows.
    assert left < 100_000
    assert accepted.count() == 1000
    assert spark.conf.get("spark.sql.parquet.compression.codec") == codec


def test_slices_are_decided_as_the_whole(spark):
    tables = many_requests(spark, 120)
    whole = posting_operator.decide_sales(*tables)
    assert {row.reason for row in whole.select("reason").distinct().collect()} >= {
        None, "not enough stock", "transaction number already exists", "customer not found", "product not found",
    }
    for ends in ([59], [10, 20, 100, 500]):
        assert bag(posting_operator.decide_sales(*tables, ends)) == bag(whole)


def test_registered_query_moves_no_more_than_a_slice_of_the_requests(spark, monkeypatch):
    from ledgerlark import session
    from ledgerlark.plans import catalog
    from tests.conftest import SMALL

    whole = bag(catalog.QUERIES["post_sales"](spark, SMALL))
    monkeypatch.setattr(session, "_WRITTEN", {})
    monkeypatch.setattr(catalog, "SLICE", 2500)
    pieces, original = [], posting_operator.materialise_pieces
    monkeypatch.setattr(
        posting_operator, "materialise_pieces", lambda many: original(pieces.append(p.count()) or p for p in many)
    )
    assert bag(catalog.QUERIES["post_sales"](spark, SMALL)) == whole
    assert max(pieces) <= 2500 and sum(pieces) == 2 * len(whole)


def test_passes_keep_no_tables_that_nothing_reads_any_more(spark, monkeypatch):
    """Each pass leaves its verdicts and what it was wrong about; states and links give way to the next."""
    from ledgerlark.session import alone

    rng = random.Random(0)
    stocks = [rng.choice([1, 4, 9]) for _ in range(4)]
    requests = []
    for seq in range(40):
        product = rng.randrange(4)
        requests.append((seq, f"N{rng.randrange(9)}", product, rng.randrange(1, 5), stocks[product]))
    df = spark.createDataFrame(requests, "seq long, number string, product_id long, quantity int, stock int")
    before, left, passes = written_tables(spark), [], []
    fates = posting_operator._fates
    monkeypatch.setattr(posting_operator, "_fates", lambda *a: passes.append(1) or fates(*a))

    def build():
        verdicts = posting_operator.admit_with_numbers(df)
        left.append(len(written_tables(spark) - before))
        return posting_operator.materialise(verdicts)

    got = {row.seq: (row.claims, row.admitted) for row in alone(build).collect()}
    assert got == posted_by_loop(requests)
    assert len(passes) >= 2
    # Besides these: the requests with their flags, and claims, state and links of the last pass.
    assert left[0] <= 2 * len(passes) - 1 + 4
    assert len(written_tables(spark) - before) == 1
