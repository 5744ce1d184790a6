"""Token ids in blocks of an adaptive, context-mixing range coder.

A block starts from nothing and can be read alone. Order 2 and order 1 guess the id that
followed the same two ids, or the same id, last time, and the better trusted guess is put
forward if it was right before. Whether it is right is one decision, whose probability
mixes what all three orders say about the guessed id, in the logistic domain, by weights
that learn from every answer; order 0 says how often the id was seen.

Ids that are not guessed are spelled by order 0: the head of a block lists those that are
spelled more than once, with their counts, and each is coded by its share of the counts.
Of those that are spelled once only the upper bits have counts, and the lower bits are kept
as they are in the head. Spelled ids hang on these counts alone, so they are coded apart
from the decisions, and no lane waits for another that spells.

Blocks know nothing of each other, so many are coded in lockstep, one numpy lane each. All
arithmetic is on integers, so a block reads the same everywhere.
"""

from __future__ import annotations

import math
import zlib

import numpy as np

#: Ids of a block, and blocks coded in lockstep.
BLOCK, LANES = 2048, 2048
#: Bits of the places of the order-1 and order-2 tables, and of the order-0 table, per lane.
CONTEXT_BITS, SEEN_BITS = 10, 9
#: Bits of an id spelled once that have counts.
UPPER_BITS = 4
# The coder keeps 64 bits and gives out 32 whenever its range falls below 32.
_FULL, _LEAST, _LOW = np.uint64((1 << 64) - 1), np.uint64(1 << 32), np.uint64((1 << 32) - 1)
_32 = np.uint64(32)
# An entry of a table is an id and one, 0 if there is none, over so many bits of trust.
_TRUST = 4
_MOST = (1 << _TRUST) - 1
_ORDERS = np.arange(3)[:, None] << _TRUST
_HASH, _HASH_2 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)
_SEEN, _CONTEXT = np.uint32(32 - SEEN_BITS), np.uint32(32 - CONTEXT_BITS)
_FAR = 1400
MAGIC = b"CMRC\x02"


def _logit(share: float) -> int:
    return round(256 * math.log(share / (1 - share)))


#: Probabilities of 12 bits by their logits, scaled by 256, from -_FAR on.
SQUASH = np.array([round(4096 / (1 + math.exp(-x / 256))) for x in range(-_FAR, _FAR + 1)], np.int32)
#: What orders 2, 1 and 0 say, by how much they trust the guess.
LOGITS = np.array(
    [_logit(low) if not t else _logit(min(most, start + step * t))
     for low, start, step, most in ((0.2, 0.12, 0.1, 0.93), (0.15, 0.1, 0.05, 0.8), (0.12, 0.1, 0.02, 0.4))
     for t in range(_MOST + 1)],
    np.int32,
)
#: How trust changes, by itself and whether the guess was right.
CHANGES = np.array(
    [(t >> 1) - t for t in range(_MOST + 1)] + [int(t < _MOST) for t in range(_MOST + 1)], np.int32
)


class Encoder:
    def __init__(self, lanes: int, room: int):
        self.lane = np.arange(lanes)
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, _FULL)
        self.out = np.zeros((lanes, room), np.uint32)
        self.n = np.zeros(lanes, np.int64)

    def _settle(self, at: np.ndarray, low: np.ndarray, add: np.ndarray, span: np.ndarray) -> None:
        """Move the lanes ``at`` up by ``add``; ``low`` and ``span`` are changed in place."""
        low += add
        lanes = at[low < add]
        place = self.n[lanes] - 1
        while len(lanes):
            self.out[lanes, place] += 1
            full = self.out[lanes, place] == 0
            lanes, place = lanes[full], place[full] - 1
        small = (span < _LEAST).nonzero()[0]
        if len(small):
            lanes, first = at[small], low[small]
            place = self.n[lanes]
            self.out[lanes, place] = first >> _32
            self.n[lanes] = place + 1
            low[small] = first << _32
            span[small] <<= _32

    def bits(self, at: np.ndarray, p: np.ndarray, yes: np.ndarray) -> np.ndarray:
        """Code a decision of each lane in ``at``; ``p`` of 4096 that it is yes."""
        low, span = self.low[at], self.range[at]
        bound = (span >> np.uint64(12)) * p.astype(np.uint64)
        span = np.where(yes, bound, span - bound)
        self._settle(at, low, bound * ~yes, span)
        self.low[at], self.range[at] = low, span
        return yes

    def shares(self, places: np.ndarray, total: np.ndarray) -> None:
        """Code where among ``total`` equal shares the first lanes' symbols are: ``places`` has
        the first share of each over its number of shares."""
        span = self.range[: len(total)]
        unit = span // total
        np.multiply(unit, places & _LOW, out=span)
        self._settle(self.lane[: len(total)], self.low[: len(total)], unit * (places >> _32), span)

    def finish(self) -> list[bytes]:
        for shift in (_32, np.uint64(0)):
            self.out[self.lane, self.n] = (self.low >> shift) & _LOW
            self.n += 1
        return [row[:n].astype(">u4").tobytes() for row, n in zip(self.out, self.n.tolist())]


class Decoder:
    def __init__(self, blocks: list[bytes]):
        self.lane = np.arange(len(blocks))
        self.data = np.zeros((len(blocks), max(map(len, blocks)) // 4 + 2), np.uint32)
        for row, block in zip(self.data, blocks):
            row[: len(block) // 4] = np.frombuffer(block, ">u4")
        self.range = np.full(len(blocks), _FULL)
        self.code = (self.data[:, 0].astype(np.uint64) << _32) | self.data[:, 1]
        self.n = np.full(len(blocks), 2, np.int64)

    def _settle(self, at: np.ndarray, code: np.ndarray, span: np.ndarray) -> None:
        small = (span < _LEAST).nonzero()[0]
        if len(small):
            lanes = at[small]
            place = self.n[lanes]
            code[small] = (code[small] << _32) | self.data[lanes, place]
            self.n[lanes] = place + 1
            span[small] <<= _32

    def bits(self, at: np.ndarray, p: np.ndarray, yes: None = None) -> np.ndarray:
        code, span = self.code[at], self.range[at]
        bound = (span >> np.uint64(12)) * p.astype(np.uint64)
        yes = code < bound
        code -= bound * ~yes
        span = np.where(yes, bound, span - bound)
        self._settle(at, code, span)
        self.code[at], self.range[at] = code, span
        return yes

    def shares(self, places: np.ndarray, base: np.ndarray, total: np.ndarray) -> np.ndarray:
        """The first shares of the first lanes' symbols; ``places`` has, from each lane's
        ``base`` on, for every share what the symbol's place is."""
        code, span = self.code[: len(total)], self.range[: len(total)]
        unit = span // total
        place = places.take(base + (code // unit).view(np.int64))
        first = place >> _32
        code -= unit * first
        np.multiply(unit, place & _LOW, out=span)
        self._settle(self.lane[: len(total)], code, span)
        return first


class Model:
    """What the lanes have learned of their blocks so far."""

    def __init__(self, lanes: int, id_bits: int):
        lane = np.arange(lanes)
        kind = np.int32 if id_bits < 31 - _TRUST else np.int64
        # Order 2 and order 1, by hashed context, and how often ids were seen, by hashed id.
        self.known = np.zeros(lanes << CONTEXT_BITS + 1, kind)
        self.often = np.zeros(lanes << SEEN_BITS, np.uint8)
        self.base = np.stack([lane << CONTEXT_BITS, (lanes + lane) << CONTEXT_BITS])
        self.seen = lane << SEEN_BITS
        self.cells = self.base.copy()
        self.weight = np.full((3, lanes), 1 << 15, np.int32)
        self.hash = np.zeros((2, lanes), np.uint32)
        self.steps = 0

    def asked(self) -> np.ndarray:
        """The lanes that ask whether their guess is right: it was right before."""
        self.entries = entries = self.known.take(self.cells)
        self.trust = trust = entries & _MOST
        two = trust[0] >= trust[1] >> 1
        self.best = np.where(two, entries[0], entries[1])
        return (self.best & _MOST > 1).nonzero()[0]

    def ask(self, coder: Encoder | Decoder, at: np.ndarray, entry: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """The guesses of the lanes in ``at``, as id and one, and whether they are right."""
        guess = self.best[at] >> _TRUST
        hashed = guess.astype(np.uint32) * _HASH >> _SEEN
        # Another guess says as much as one that is not trusted.
        says = np.empty((3, len(at)), np.int64)
        np.multiply(self.trust[:, at], self.entries[:, at] >> _TRUST == guess, out=says[:2])
        says[2] = self.often.take(self.seen[at] + hashed)
        says += _ORDERS
        inputs, weight = LOGITS.take(says), self.weight[:, at]
        mixed = (weight * inputs).sum(axis=0, dtype=np.int32) >> 16
        p = SQUASH.take(mixed + _FAR, mode="clip")
        yes = coder.bits(at, p, None if entry is None else guess == entry[at])
        weight += inputs * (yes * np.int32(4095) - p) >> 7
        self.weight[:, at] = np.clip(weight, -(1 << 18), 1 << 18)
        return guess, yes

    def learn(self, entry: np.ndarray) -> None:
        """What came next, as id and one."""
        entries, trust = self.entries, self.trust
        fresh = entry << _TRUST
        right = entries ^ fresh <= _MOST
        kept = entries + CHANGES.take(trust + (right << _TRUST))
        self.known[self.cells] = np.where(right | (trust > 1), kept, fresh | 1)
        last = entry.astype(np.uint32) * _HASH
        cell = self.seen + (last >> _SEEN)
        self.often[cell] = np.minimum(self.often.take(cell) + np.uint8(1), _MOST)
        self.hash[0] += last
        self.hash[1] = last
        np.add(self.base, self.hash >> _CONTEXT, out=self.cells)
        self.hash[0] = entry.astype(np.uint32) * _HASH_2


def _kept(n: int, width: int | np.ndarray) -> tuple | np.ndarray:
    """Where the last ``width`` bits of ``n`` numbers of 32 bits are."""
    if isinstance(width, int):
        return np.s_[:, 32 - width :]
    return np.arange(32) >= 32 - width[:, None]


def _bits(values: np.ndarray, width: int | np.ndarray) -> np.ndarray:
    """The last ``width`` bits of each value, one after the other."""
    whole = np.unpackbits(values.astype(">u4").view(np.uint8)).reshape(-1, 32)
    return whole[_kept(len(values), width)].ravel()


def _values(bits: np.ndarray, n: int, width: int | np.ndarray) -> np.ndarray:
    whole = np.zeros((n, 32), np.uint8)
    if isinstance(width, int):
        whole[:, 32 - width :] = bits[: n * width].reshape(n, width)
    else:
        whole[_kept(n, width)] = bits[: int(width.sum())]
    return np.packbits(whole.ravel()).view(">u4").astype(np.int64)


def _lower_bits(n: int, id_bits: int) -> int:
    """Bits of each of ``n`` listed ids that are kept as they are."""
    return max(0, id_bits - n.bit_length())


def _spelling(ids: np.ndarray, counts: np.ndarray, upper: np.ndarray, singles: np.ndarray, id_bits: int) -> bytes:
    """The head of a block: the ids spelled more than once, ascending, and their counts, how
    many ids spelled once have which upper bits, and these ids, whose lower bits are kept."""
    n = len(ids)
    lower = _lower_bits(n, id_bits)
    numbers = np.concatenate([counts - 1, upper + 1])
    widths = np.frexp(numbers)[1]
    # The upper bits of listed ids, and the widths of numbers, are the zeros before each one.
    steps = np.concatenate([np.diff(ids >> lower, prepend=0) + 1, widths])
    ones = np.zeros(int(steps.sum()), np.uint8)
    ones[np.cumsum(steps) - 1] = 1
    rest = _bits(singles, max(id_bits - UPPER_BITS, 0))
    data = np.packbits(np.concatenate([_bits(ids, lower), ones, _bits(numbers, widths - 1), rest])).tobytes()
    return np.array([n, len(data)], "<u4").tobytes() + data


def _read_spelling(data: bytes, id_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Symbols and their counts, the lower bits of ids spelled once, and where the code starts.
    A symbol is a listed id, or the upper bits of others behind all ids."""
    n, size = np.frombuffer(data[:8], "<u4").tolist()
    bits = np.unpackbits(np.frombuffer(data[8 : 8 + size], np.uint8))
    lower = _lower_bits(n, id_bits)
    ids = _values(bits, n, lower)
    bits = bits[n * lower :]
    ones = bits.nonzero()[0][: 2 * n + (1 << UPPER_BITS)]
    steps = np.diff(ones, prepend=-1)
    ids += np.cumsum(steps[:n] - 1) << lower
    widths = steps[n:] - 1
    bits = bits[int(ones[-1]) + 1 :]
    numbers = _values(bits, len(widths), widths) + (1 << widths)
    counts, upper = numbers[:n] + 1, numbers[n:] - 1
    singles = _values(bits[int(widths.sum()) :], int(upper.sum()), max(id_bits - UPPER_BITS, 0))
    some = upper.nonzero()[0]
    return np.append(ids, some + (1 << id_bits)), np.append(counts, upper[some]), singles, 8 + size


def _by_length(n: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Lanes by falling ``n``, and how many of them have more than 0, 1, 2... each."""
    order = np.argsort(-n, kind="stable")
    return order, np.searchsorted(-n[order], -np.arange(int(n.max())), side="left").tolist()


def _spelled(ids: np.ndarray, spelled: np.ndarray, id_bits: int) -> tuple[np.ndarray, list[bytes]]:
    """Of each spelled id, lane by lane, its first share over its number of shares, and the
    heads of the blocks."""
    lanes, n = len(ids), spelled.sum(axis=1)
    own, ends = ids[spelled], np.cumsum(n)
    place_bits = int(n.max()).bit_length()
    rows = np.full((lanes, int(n.max())), np.iinfo(np.int64).max)
    filled = np.arange(rows.shape[1]) < n[:, None]
    rows[filled] = own << place_bits | np.broadcast_to(np.arange(rows.shape[1]), rows.shape)[filled]
    rows.sort(axis=1)
    rows = rows[filled]
    ids, lane = rows >> place_bits, np.repeat(np.arange(lanes), n)
    place = (rows & (1 << place_bits) - 1) + (ends - n)[lane]
    # Runs of equal ids; no run crosses lanes.
    starts = np.append(True, ids[1:] != ids[:-1]) if len(ids) else np.zeros(0, bool)
    starts[(ends - n)[n > 0]] = True
    runs = np.flatnonzero(starts)
    size = np.diff(runs, append=len(ids))
    once = size == 1
    rest = max(id_bits - UPPER_BITS, 0)
    cell = (lane[runs] << UPPER_BITS) + (ids[runs] >> rest)
    upper = np.bincount(cell[once], minlength=lanes << UPPER_BITS)
    listed = np.where(once, 0, size)
    total = np.bincount(lane[runs], listed, lanes).astype(np.int64)
    many = np.cumsum(listed) - listed
    before = np.cumsum(upper).reshape(lanes, -1) - upper.reshape(lanes, -1)
    before += (total - before[:, 0])[:, None]
    first = np.where(once, before.ravel()[cell], many - (np.cumsum(total) - total)[lane[runs]])
    size[once] = upper[cell[once]]
    places = np.empty(len(ids), np.uint64)
    places[place] = np.repeat(first << 32 | size, np.diff(runs, append=len(ids)))
    alone = np.zeros(len(ids), bool)
    alone[place[runs[once]]] = True
    cuts = [0, *np.cumsum(np.bincount(lane[runs[~once]], minlength=lanes)).tolist()]
    ones = [0, *np.cumsum(np.bincount(lane[runs[once]], minlength=lanes)).tolist()]
    kept, counts, singles = ids[runs[~once]], size[~once], own[alone]
    return places, [
        _spelling(kept[a:b], counts[a:b], some, singles[c:d], id_bits)
        for a, b, c, d, some in zip(cuts, cuts[1:], ones, ones[1:], upper.reshape(lanes, -1))
    ]


def _encode_blocks(ids: np.ndarray, sizes: np.ndarray, id_bits: int) -> list[bytes]:
    """Blocks of the rows of ``ids``, of which the first ``sizes`` count."""
    lanes, block = ids.shape
    model = Model(lanes, id_bits)
    # At most a decision takes 8 bits against it, and an id its share of the counts.
    coder = Encoder(lanes, -(-block * 9 // 32) + 4)
    spelled = np.ones((block, lanes), bool)
    least = int(sizes.min())
    for t, entry in enumerate(np.ascontiguousarray(ids.T).astype(model.known.dtype) + 1):
        at = model.asked()
        if t >= least:
            at = at[t < sizes[at]]
        _, right = model.ask(coder, at, entry)
        spelled[t, at[right]] = False
        model.learn(entry)
    spelled[np.arange(block)[:, None] >= sizes] = False
    decisions = coder.finish()
    spelled = np.ascontiguousarray(spelled.T)
    places, heads = _spelled(ids, spelled, id_bits)
    n = spelled.sum(axis=1)
    order, active = _by_length(n)
    coder = Encoder(lanes, -(-block * (1 + block.bit_length()) // 32) + 4)
    total, begin = n[order].astype(np.uint64), (np.cumsum(n) - n)[order]
    for t, m in enumerate(active):
        coder.shares(places.take(begin[:m] + t), total[:m])
    codes = coder.finish()
    return [head + codes[i] + decision for head, i, decision in zip(heads, np.argsort(order).tolist(), decisions)]


def _decode_blocks(blocks: list[bytes], sizes: np.ndarray, id_bits: int) -> np.ndarray:
    lanes, block = len(blocks), int(sizes.max())
    heads = [_read_spelling(data, id_bits) for data in blocks]
    n = np.array([counts.sum() for _, counts, _, _ in heads])
    symbols = np.concatenate([x[0] for x in heads])
    counts = np.concatenate([x[1] for x in heads])
    starts, base = np.cumsum(counts) - counts, np.cumsum(n) - n
    first = starts - np.repeat(base, [len(x[0]) for x in heads])
    places = np.repeat((first << 32 | counts).astype(np.uint64), counts)
    order, active = _by_length(n)
    codes = [data[x[3] :] for data, x in zip(blocks, heads)]
    coder = Decoder([codes[i] for i in order.tolist()])
    total, begin = n[order].astype(np.uint64), base[order]
    found = np.zeros(len(places), np.int64)
    for t, m in enumerate(active):
        found[begin[:m] + t] = coder.shares(places, begin[:m], total[:m])
    # The decisions begin where the shares end.
    ends = np.empty(lanes, np.int64)
    ends[order] = 4 * coder.n
    own = np.repeat(symbols, counts).take(found + np.repeat(base, n))
    once = np.flatnonzero(own >> id_bits)
    own[once] = (own[once] - (1 << id_bits) << max(id_bits - UPPER_BITS, 0)) | np.concatenate([x[2] for x in heads])
    model = Model(lanes, id_bits)
    own = np.append(own, 0).astype(model.known.dtype) + 1
    coder = Decoder([code[end:] for code, end in zip(codes, ends.tolist())])
    least = int(sizes.min())
    out = np.empty((block, lanes), np.uint32)
    for t in range(block):
        at = model.asked()
        if t >= least:
            at = at[t < sizes[at]]
        guess, yes = model.ask(coder, at, None)
        entry = own.take(base, mode="clip")
        base += 1
        right = at[yes]
        entry[right] = guess[yes]
        base[right] -= 1
        out[t] = entry
        model.learn(entry)
    return (out - np.uint32(1)).T


def encode_ids(ids: np.ndarray, id_bits: int = 16, block: int = BLOCK, lanes: int = LANES) -> bytes:
    """A file of ids: a header, and for each block its sizes, checksum and code."""
    if len(ids) and int(ids.max()) >> id_bits:
        raise ValueError(f"an id has more than {id_bits} bits")
    n_blocks = -(-len(ids) // block)
    heads, codes = [], []
    for lo in range(0, n_blocks, lanes):
        hi = min(lo + lanes, n_blocks)
        part = ids[lo * block : hi * block].astype(np.int64)
        sizes = np.full(hi - lo, block, np.int64)
        sizes[-1] = len(part) - block * (hi - lo - 1)
        table = np.zeros((hi - lo) * block, np.int64)
        table[: len(part)] = part
        for code, size in zip(_encode_blocks(table.reshape(hi - lo, block)[:, : int(sizes.max())], sizes, id_bits), sizes):
            heads.append((int(size), len(code), zlib.crc32(code)))
            codes.append(code)
    head = np.array([len(ids), block, id_bits, n_blocks], "<u8").tobytes()
    table = np.array(heads, "<u4").reshape(-1, 3).tobytes()
    return MAGIC + head + table + zlib.crc32(head + table).to_bytes(4, "little") + b"".join(codes)


def decode_ids(data: bytes, lanes: int = LANES) -> np.ndarray:
    """The ids of a file; a ``ValueError`` if any of it is damaged."""
    at = len(MAGIC)
    head = np.frombuffer(data[at : at + 32], "<u8") if len(data) >= at + 32 else []
    if data[:at] != MAGIC or len(head) != 4:
        raise ValueError("not a file of ids")
    total, block, id_bits, n_blocks = map(int, head)
    stop = at + 32 + 12 * n_blocks
    if zlib.crc32(data[at:stop]) != int.from_bytes(data[stop : stop + 4], "little"):
        raise ValueError("the header is damaged")
    table = np.frombuffer(data[at + 32 : stop], "<u4").reshape(-1, 3).astype(np.int64)
    ends = stop + 4 + np.cumsum(table[:, 1])
    codes = [data[e - n : e] for e, n in zip(ends.tolist(), table[:, 1].tolist())]
    if any(zlib.crc32(code) != crc for code, crc in zip(codes, table[:, 2].tolist())):
        raise ValueError("a block is damaged")
    parts = [np.zeros(0, np.uint32)]
    for lo in range(0, n_blocks, lanes):
        sizes = table[lo : lo + lanes, 0]
        out = _decode_blocks(codes[lo : lo + lanes], sizes, id_bits)
        parts.append(out.ravel() if sizes.min() == out.shape[1]
                     else np.concatenate([row[:n] for row, n in zip(out, sizes)]))
    ids = np.concatenate(parts)
    if len(ids) != total:
        raise ValueError("ids are missing")
    return ids
