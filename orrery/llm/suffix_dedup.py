"""Removal of repeated byte strings by difference-cover suffix sorting.

Every byte of a document that lies in a string of ``length`` bytes which also
starts in a document of smaller doc_id is removed. Strings are judged on the
input, overlaps count, matches do not cross documents.

A suffix array of the whole corpus would send every suffix through several
sorts. Two exact steps keep most of them out of it:

1. Winnowing. Of a window of ``length`` bytes the minimizer is the least hash
   among its grams of ``GRAM`` bytes. Equal windows have equal minimizers, so
   a window can repeat only if its minimizer occurs in two documents. Batches
   send their distinct minimizers to shards by hash and get back which occur
   elsewhere (one bit each).
2. Neighbouring windows of one minimizer form a run. Runs with a repeated
   minimizer go, as bytes, to the shard of the minimizer; equal runs are kept
   once there, for the least document.

Each shard then sorts the suffixes of its runs: triples at positions 1 and 2
modulo 3 are sorted and named, the string of names is sorted by recursion
until names differ or cover the length, the remaining suffixes are merged in
by their first byte and the rank after it, and neighbours in the order whose
prefixes are equal form the classes of equal windows. All but the windows of a
class's least document are removed.

A minimizer of more than ``HOT`` occurrences has its windows sent one by one,
by the hash of the window, each once a batch: no shard gets more of a frequent
passage than one row for each batch.

Null texts are empty. Rows without doc_id are never earlier or later than any
other and stay whole. Rows that repeat a doc_id do not match each other. The
remaining bytes may cut characters; ``kept`` holds them as they are, ``text``
without the broken characters.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import Powers, find, in_small_batches, mix, prefix_sums, saved, span_hashes, utf8

GRAM = 24
#: Bytes that one vectorised step works on, and how many times that a batch has:
#: each batch sends a message to each shard, so there are to be few of them.
PACK_BYTES = 1 << 18
PIECES = 16
HOT = 1 << 14
#: Bytes sorted at once; a frequent minimizer's strings may be more.
SORT_BYTES = 1 << 18


# ---- suffix sorting -------------------------------------------------------

def names_of(keys: np.ndarray):
    """Dense ranks (from 1) of the keys and how many there are."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(new)
    return out, int(new.sum())


def _joined(a: np.ndarray, b: np.ndarray, many: int) -> np.ndarray:
    """Numbers in the order of the pairs (a, b), b below ``many``."""
    wide = np.uint64(max(int(many) - 1, 1).bit_length())
    if int(a.max(initial=0)).bit_length() + int(wide) > 64:
        a = names_of(a)[0].astype(np.uint64)
    return a << wide | b


def suffix_order(s: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``s`` (numbers from 1) ordered by their suffixes; those
    that agree on ``depth`` numbers stand side by side in any order."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    t = np.concatenate((s, np.zeros(3, np.int64))).astype(np.uint64)
    high = int(s.max()) + 1
    index = np.arange(n)
    ones, twos, rest = index[1::3], index[2::3], index[::3]
    sample = np.concatenate((ones, twos))
    name, many = names_of(_joined(_joined(t[sample], t[sample + 1], high), t[sample + 2], high))
    if many == len(sample) or depth <= 3:
        order = np.argsort(name)
    else:
        # a least number ends the first half, so that its last triples do not go on in the second
        string = np.concatenate((name[:len(ones)], [0], name[len(ones):])) + 1
        order = suffix_order(string, -(-depth // 3))
        order = order[order != len(ones)]
        order -= order > len(ones)
    # rank of each sampled position, 0 beyond the end
    rank = np.zeros(n + 3, np.uint64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    sampled = sample[order]
    ranks = len(sample) + 1

    def by_one(p):  # first number, then the rank after it
        return _joined(t[p], rank[p + 1], ranks)

    def by_two(p):
        return _joined(_joined(t[p], t[p + 1], high), rank[p + 2], ranks)

    is_one = sampled % 3 == 1
    one, two = sampled[is_one], sampled[~is_one]
    both = by_one(np.concatenate((rest, one)))  # named together if they must be
    turn = np.argsort(both[:len(rest)])
    less = np.searchsorted(both[len(rest):], both[:len(rest)][turn])
    both = by_two(np.concatenate((rest, two)))
    less += np.searchsorted(both[len(rest):], both[:len(rest)][turn])
    out = np.full(n, -1, np.int64)
    out[np.maximum.accumulate(less) + np.arange(len(rest))] = rest[turn]
    out[out < 0] = sampled
    return out


def window_classes(text: np.ndarray, windows: np.ndarray, length: int):
    """(windows in order, class number of each): windows of ``length`` bytes
    at the given positions, equal ones in one class."""
    order = suffix_order(text.astype(np.int64) + 1, length)
    mine = np.zeros(len(text), bool)
    mine[windows] = True
    order = order[mine[order]]
    padded = np.concatenate((text, np.zeros(length + 8, np.uint8)))
    same = np.ones(max(len(order) - 1, 0), bool)
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    for k in [*range(0, length - 7, 8), length - 8] if length >= 8 else []:
        w = words[order + k].view(np.uint64).ravel() if len(order) else np.zeros(0, np.uint64)
        same &= w[1:] == w[:-1]
    for k in range(length if length < 8 else 0):
        same &= padded[order[1:] + k] == padded[order[:-1] + k]
    return order, np.cumsum(np.concatenate(([True], ~same)))[:len(order)]


# ---- windows and runs of one batch ----------------------------------------

class Pack:
    """Some documents' bytes side by side, each in parts of bounded size that
    look ``length`` - 1 bytes ahead, and their runs: windows [start, end) of one
    minimizer (value) in a part. A few parts at a time are looked through."""

    def __init__(self, data: bytes, ends: np.ndarray, length: int, powers: Powers):
        self.buf, self.length = np.frombuffer(data, np.uint8), length
        self.begins = np.concatenate(([0], ends[:-1]))
        at, found = 0, []
        while at < len(ends):
            base = int(self.begins[at])
            to = max(at + 1, int(np.searchsorted(ends, base + PACK_BYTES, "right")))
            start, end, value, part = _runs(self.buf[base:int(ends[to - 1])], self.begins[at:to] - base, ends[at:to] - base, length, powers)
            found.append((start + base, end + base, value, part + at))
            at = to
        none = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        self.start, self.end, self.value, self.part = (np.concatenate(x) for x in zip(*found or none))


def _runs(buf: np.ndarray, begins: np.ndarray, ends: np.ndarray, length: int, powers: Powers):
    """(start, end, minimizer, part) of the runs of the parts [begins, ends)."""
    n, gram = len(buf), min(GRAM, length)
    many = np.maximum(ends - begins - length + 1, 0)  # windows of each part
    part = np.repeat(np.arange(len(ends)), many)
    if not len(part):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    valid = np.arange(len(part)) + np.repeat(begins - (np.cumsum(many) - many), many)
    _, down = powers.upto(n + 1)
    sums = prefix_sums(buf, powers)
    h = sums[gram:] - sums[:-gram]
    h *= down[:len(h)]
    h = mix(h) >> np.uint64(16)
    width, least, have = length - gram + 1, h, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    value = least[valid]
    first = np.flatnonzero(np.concatenate(([True], (value[1:] != value[:-1]) | (part[1:] != part[:-1]))))
    start = valid[first]
    return start, start + np.diff(np.append(first, len(valid))), value[first], part[first]


def _squeeze(a: np.ndarray) -> bytes:
    """Numbers by byte planes, compressed: small ones and differences take little."""
    import zstandard

    a = np.ascontiguousarray(a)
    return zstandard.compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes(), 1)


def _spread(b: bytes, kind) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.decompress(b), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def _unpack(row: dict, length: int, powers: Powers) -> Pack:
    import zstandard

    return Pack(zstandard.decompress(row["data"]), _spread(row["ends"], np.int64), length, powers)


PACKED = "batch long, data binary, ends binary, ids binary, keys binary, offsets binary"


def pack(docs: DataFrame, length: int) -> DataFrame:
    """Batches of documents, written once so that their make-up is fixed."""
    most = PIECES * PACK_BYTES

    def run(batches):
        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for b in in_small_batches(batches, most):
            parts, ids, keys, offsets = [], [], [], []
            for i, t, k in zip(b.column(0).to_pylist(), utf8(b.column(1)), b.column(2).to_pylist(), strict=True):
                for at in range(0, max(len(t or b"") - length + 1, 0), PACK_BYTES):
                    parts.append(t[at:at + PACK_BYTES + length - 1])
                    ids.append(i)
                    keys.append(k)
                    offsets.append(at)
            at = 0
            while at < len(parts):  # the parts of a long text in batches of their own
                to, size = at + 1, len(parts[at])
                while to < len(parts) and size + len(parts[to]) <= most:
                    size += len(parts[to])
                    to += 1
                yield pa.RecordBatch.from_pydict({
                    "batch": [number], "data": [zstandard.compress(b"".join(parts[at:to]), 3)],
                    "ends": [_squeeze(np.cumsum([len(x) for x in parts[at:to]]).astype(np.int64))],
                    **{c: [_squeeze(np.array(v[at:to], np.int64))] for c, v in (("ids", ids), ("keys", keys), ("offsets", offsets))}})
                number += 1
                at = to

    return docs.where("doc_id is not null").mapInArrow(run, PACKED)


# ---- which minimizers repeat ----------------------------------------------

def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return (h % np.uint64(shards)).astype(np.int64)


def _by_number(shard: np.ndarray):
    """(shard, indices of its members in their order) of the shards that occur."""
    order = np.argsort(shard.astype(np.uint16) if shard.max(initial=0) < 1 << 16 else shard, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], np.diff(shard[order]) != 0))) if len(order) else order
    return zip(shard[order[first]].tolist(), np.split(order, first[1:]))


def _one_by_one(batches):
    """Rows as dicts; all of a batch at once would take much memory."""
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def _minimizers(p: Pack, ids: np.ndarray):
    """Distinct minimizers, how often each occurs, and if in two documents."""
    doc = ids[p.part]
    order = np.argsort(p.value, kind="stable")
    value, doc = p.value[order], doc[order]
    first = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1]))) if len(value) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(value)))
    several = np.maximum.reduceat(doc, first) != np.minimum.reduceat(doc, first) if len(first) else np.zeros(0, bool)
    return value[first], count, several


def repeated_minimizers(packed: DataFrame, length: int, shards: int) -> DataFrame:
    """(batch, shard, bits): for a batch's sorted minimizers of a shard, 0 if
    one is in no second document, 1 if it is, 2 if it is frequent."""
    def send(batches):
        import pyarrow as pa

        powers = Powers()
        for row in _one_by_one(batches):
            value, count, several = _minimizers(_unpack(row, length, powers), _spread(row["ids"], np.int64))
            out = {"shard": [], "batch": [], "hashes": [], "counts": []}
            for s, mine in _by_number(_shard(value, shards)):
                out["shard"].append(s)
                out["batch"].append(row["batch"])
                out["hashes"].append(_squeeze(np.diff(value[mine], prepend=np.uint64(0))))
                out["counts"].append(_squeeze((np.minimum(count[mine], 32767) * 2 + several[mine]).astype(np.uint16)))
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("shard", pa.int64()), ("batch", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())]))

    def answer(batches):
        import pyarrow as pa

        for rows in _by_shard(batches):
            hashes = [np.cumsum(_spread(r["hashes"], np.uint64), dtype=np.uint64) for r in rows]
            counts = [_spread(r["counts"], np.uint16).astype(np.int64) for r in rows]
            every, number = np.concatenate(hashes), np.concatenate(counts)
            order = np.argsort(every)
            ranked, number = every[order], number[order]
            first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
            size = np.diff(np.append(first, len(ranked)))
            again = (size > 1) | (np.maximum.reduceat(number & 1, first) > 0)
            bits = again.astype(np.uint8) + (again & (np.add.reduceat(number >> 1, first) > HOT))
            known = ranked[first]
            yield pa.RecordBatch.from_pydict({
                "batch": [r["batch"] for r in rows], "shard": [r["shard"] for r in rows],
                "bits": [_squeeze(bits[find(known, h)]) for h in hashes]},
                schema=pa.schema([("batch", pa.int64()), ("shard", pa.int64()), ("bits", pa.binary())]))

    sent = packed.mapInArrow(send, "shard long, batch long, hashes binary, counts binary")
    return sent.repartition(shards, "shard").sortWithinPartitions("shard") \
        .mapInArrow(answer, "batch long, shard long, bits binary")


def _by_shard(batches):
    """Lists of the rows of each shard; partitions are sorted by shard."""
    rows: list = []
    for b in batches:
        for r in b.to_pylist():
            if rows and rows[-1]["shard"] != r["shard"]:
                yield rows
                rows = []
            rows.append(r)
    if rows:
        yield rows


# ---- repeated windows -----------------------------------------------------

def _contexts(p: Pack, bits: dict, shards: int, ids: np.ndarray):
    """Runs whose minimizer repeats, as (shard key, document, start, windows),
    each different string once, for the least document; and the runs that the
    batch itself shows to be in a smaller document."""
    value, _, _ = _minimizers(p, ids)
    mark = np.zeros(len(value), np.uint8)
    for s, mine in _by_number(_shard(value, shards)):
        mark[mine] = bits[s]
    mark = mark[find(value, p.value)] if len(p.value) else mark[:0]
    runs, hot = np.flatnonzero(mark == 1), np.flatnonzero(mark == 2)
    start, size, key, part = p.start[runs], (p.end - p.start)[runs], p.value[runs], p.part[runs]
    if len(hot):
        n = (p.end - p.start)[hot]
        single = np.repeat(p.start[hot] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        start, size = np.concatenate((start, single)), np.concatenate((size, np.ones(len(single), np.int64)))
        part = np.concatenate((part, np.repeat(p.part[hot], n)))
        key = np.concatenate((key, np.zeros(len(single), np.uint64)))
    return start, size, key, part, len(runs)


def _strings(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of the strings [start, start + size) one after another."""
    at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    return buf[at]


def _least_of_equal(key: np.ndarray, check: np.ndarray, size: np.ndarray, doc: np.ndarray):
    """Of equal strings (by two hashes and size) the one of the least document:
    indices of these, and for each string its index among them."""
    order = np.lexsort((doc, size, check, key))
    k, c, z = key[order], check[order], size[order]
    new = np.concatenate(([True], (k[1:] != k[:-1]) | (c[1:] != c[:-1]) | (z[1:] != z[:-1]))) if len(key) else np.zeros(0, bool)
    place = np.empty(len(key), np.int64)
    place[order] = np.cumsum(new) - 1
    return order[new], place


class _Hashes:
    """Two 64-bit hashes by different bases."""

    def __init__(self, powers: Powers | None = None):
        self.powers = powers or Powers(), Powers(0xD6E8FEB86659FD93)

    def __call__(self, buf, start, end):
        out = [np.empty(len(start), np.uint64) for _ in self.powers]
        order = np.argsort(start, kind="stable")
        turn, at = start[order], 0
        while at < len(order):  # some bytes at a time
            to = int(np.searchsorted(turn, turn[at] + PACK_BYTES, "right"))
            mine, lo = order[at:to], int(turn[at])
            piece, a, z = buf[lo:int(end[mine].max())], start[mine] - lo, end[mine] - lo
            for o, p in zip(out, self.powers):
                o[mine] = span_hashes(prefix_sums(piece, p), a, z, p)
            at = to
        return out


SENT = "shard long, batch long, doc binary, part binary, start binary, windows binary, data binary"
COVERED = "batch long, part binary, start binary, windows binary"


def _covered(batch, part, start, size):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({"batch": [batch], "part": [_squeeze(part.astype(np.int64))],
                                       "start": [_squeeze(start.astype(np.int64))], "windows": [_squeeze(size.astype(np.int64))]})


def covered_windows(packed: DataFrame, bits: DataFrame, length: int, shards: int) -> DataFrame:
    """(batch, part, start, windows): windows that a smaller document has, by
    positions in the batch."""
    replies = bits.groupBy("batch").agg(F.collect_list(F.struct("shard", "bits")).alias("replies"))
    joined = packed.join(replies, "batch")

    def send(batches):
        import pyarrow as pa
        import zstandard

        powers = Powers()
        hashes = _Hashes(powers)
        kind = pa.schema([("shard", pa.int64()), ("batch", pa.int64()), *((c, pa.binary()) for c in ("doc", "part", "start", "windows", "data"))])
        for row in _one_by_one(batches):
            p, ids = _unpack(row, length, powers), _spread(row["ids"], np.int64)
            start, size, key, part, plain = _contexts(p, {r["shard"]: _spread(r["bits"], np.uint8) for r in row["replies"]}, shards, ids)
            if not len(start):
                continue
            one, two = hashes(p.buf, start, start + size + length - 1)
            key[plain:] = one[plain:] >> np.uint64(16)
            doc = ids[part]
            least, place = _least_of_equal(one, two, size, doc)
            out = {c: [] for c in kind.names}
            # what a smaller document of the batch has is settled here
            settled = np.flatnonzero(doc > doc[least][place])
            if len(settled):
                out["shard"].append(-1 - row["batch"] % shards)
                out["batch"].append(row["batch"])
                for c, v in (("doc", doc), ("part", part), ("start", start), ("windows", size)):
                    out[c].append(_squeeze(v[settled].astype(np.int64)))
                out["data"].append(b"")
            # all that its least document has goes on
            go = np.flatnonzero(doc == doc[least][place])
            for s, mine in _by_number(_shard(key[go], shards)):
                mine = go[mine]
                out["shard"].append(s)
                out["batch"].append(row["batch"])
                for c, v in (("doc", doc), ("part", part), ("start", start), ("windows", size)):
                    out[c].append(_squeeze(v[mine].astype(np.int64)))
                out["data"].append(zstandard.compress(_strings(p.buf, start[mine], size[mine] + length - 1).tobytes(), 3))
            yield pa.RecordBatch.from_pydict(out, schema=kind)

    def sort(batches):
        hashes = _Hashes()
        for rows in _by_shard(batches):
            yield from _settled(rows, hashes, length)

    return joined.mapInArrow(send, SENT).repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(sort, COVERED)


def _settled(rows: list, hashes: _Hashes, length: int):
    """The covered windows among the strings that one shard got."""
    import zstandard

    if rows[0]["shard"] < 0:
        for r in rows:
            yield _covered(r["batch"], *(_spread(r[c], np.int64) for c in ("part", "start", "windows")))
        return
    doc, size = (np.concatenate([_spread(r[c], np.int64) for r in rows]) for c in ("doc", "windows"))
    data, parts = [], []
    for r in rows:
        data.append(zstandard.decompress(r["data"]))
        n = _spread(r["windows"], np.int64) + length - 1
        parts.append(hashes(np.frombuffer(data[-1], np.uint8), np.cumsum(n) - n, np.cumsum(n)))
    data = np.frombuffer(b"".join(data), np.uint8)
    span = size + length - 1
    at = np.cumsum(span) - span
    one, two = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    least, place = _least_of_equal(one, two, size, doc)
    # windows of equal strings share their fate, but for the least document's own
    earlier = _earlier(data, at[least], size[least], doc[least], length)
    some = np.zeros(len(least), bool)
    some[list(earlier)] = True
    end = 0
    for r in rows:
        n = len(_spread(r["windows"], np.int64))
        mine = np.arange(end, end + n)
        end += n
        part, start = _spread(r["part"], np.int64), _spread(r["start"], np.int64)
        whole = doc[mine] > doc[least][place[mine]]
        single = [(k, w, m) for k in np.flatnonzero(~whole & some[place[mine]]) for w, m in earlier[int(place[mine[k]])]]
        got = [np.concatenate((v[whole], np.array(x, np.int64))) for v, x in (
            (part, [part[k] for k, _, _ in single]), (start, [start[k] + w for k, w, _ in single]),
            (size[mine], [m for _, _, m in single]))]
        if len(got[0]):
            yield _covered(r["batch"], *got)


def _earlier(data, at, size, doc, length):
    """String number -> [(first window, windows)] that a smaller document has
    too, over the windows of the given different strings."""
    out: dict = {}
    span = size + length - 1
    for mine in _sortable(data, at, span, length):
        text = _strings(data, at[mine], span[mine])
        begin = np.cumsum(span[mine]) - span[mine]
        owner = np.repeat(np.arange(len(mine)), size[mine])
        window = np.repeat(begin - (np.cumsum(size[mine]) - size[mine]), size[mine]) + np.arange(len(owner))
        order, group = window_classes(text, window, length)
        back = np.zeros(len(text), np.int64)
        back[window] = owner
        d = doc[mine][back[order]]
        first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        least = np.repeat(np.minimum.reduceat(d, first), np.diff(np.append(first, len(d)))) if len(d) else d
        hit = np.sort(order[d > least])
        if not len(hit):
            continue
        who = back[hit]
        new = np.concatenate(([True], (hit[1:] != hit[:-1] + 1) | (who[1:] != who[:-1])))
        begin_at = np.flatnonzero(new)
        for k, m in zip(begin_at, np.diff(np.append(begin_at, len(hit)))):
            out.setdefault(int(mine[who[k]]), []).append((int(hit[k] - begin[who[k]]), int(m)))
    return out


def _sortable(data, at, span, length):
    """Groups of strings, of at most SORT_BYTES where more than one minimizer
    is left; equal windows are always in one group. A minimizer of one string
    only is left out: what equals that string is known already."""
    # the minimizer of a string's first window is that of all its windows
    p, gram, step = Powers(), min(GRAM, length), 1 << 13
    least = np.full(len(at), np.iinfo(np.uint64).max, np.uint64)
    width = length - gram + 1
    for lo in range(0, len(at), step):
        some = at[lo:lo + step]
        sums = prefix_sums(_strings(data, some, np.full(len(some), length)), p)
        _, down = p.upto(len(sums))
        h = sums[gram:] - sums[:-gram]
        h *= down[:len(h)]
        h = mix(h)
        inside = np.lib.stride_tricks.as_strided(h, (len(some), width), (length * 8, 8))
        least[lo:lo + step] = inside.min(axis=1) >> np.uint64(16)
    order = np.argsort(least, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], least[order][1:] != least[order][:-1]))) if len(order) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(order)))
    order = order[np.repeat(size > 1, size)]
    cut = np.flatnonzero(np.concatenate(([True], least[order][1:] != least[order][:-1]))) if len(order) else first
    ends = np.cumsum(span[order])
    lo = 0
    while lo < len(order):
        before = ends[lo - 1] if lo else 0
        full = int(np.searchsorted(ends, before + SORT_BYTES, "right"))
        k = int(np.searchsorted(cut, full, "right")) - 1
        hi = int(cut[k]) if full < len(order) else len(order)
        if hi <= lo:  # one minimizer alone is larger
            hi = int(cut[k + 1]) if k + 1 < len(cut) else len(order)
        yield order[lo:hi]
        lo = hi


# ---- the operator ---------------------------------------------------------

def _small(rows: DataFrame) -> DataFrame:
    """The rows with their text compressed (z), for the last join."""
    kind = f"doc_id long, z binary, row_key long, rest {rows.schema['rest'].dataType.simpleString()}"

    def run(batches):
        import pyarrow as pa
        import zstandard

        shrink = zstandard.ZstdCompressor(level=1).compress
        for b in in_small_batches(batches, 4 << 20):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shrink(t or b"") for t in utf8(b.column(1))], pa.binary()),
                                              b.column(2), b.column(3)], ["doc_id", "z", "row_key", "rest"])

    return rows.mapInArrow(run, kind)


def _spans(packed: DataFrame, covered: DataFrame, length: int) -> DataFrame:
    """(doc_id, row_key, spans): covered bytes as [start, end, start, end ...]."""
    gathered = covered.groupBy("batch").agg(F.collect_list(F.struct("part", "start", "windows")).alias("found"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for row in b.to_pylist():
                part, start, size = (np.concatenate([_spread(f[c], np.int64) for f in row["found"]]) for c in ("part", "start", "windows"))
                ends, ids, keys, offsets = (_spread(row[c], np.int64) for c in ("ends", "ids", "keys", "offsets"))
                order = np.lexsort((start, part))
                part, start, end = part[order], start[order], start[order] + size[order] + length - 1
                # within a part, ends before each start; parts do not overlap in the batch
                reach = np.maximum.accumulate(end)
                new = np.concatenate(([True], (start[1:] > reach[:-1]) | (part[1:] != part[:-1])))
                first = np.flatnonzero(new)
                p, a, z = part[first], start[first], reach[np.append(first[1:] - 1, len(reach) - 1)]
                shift = offsets[p] - np.concatenate(([0], ends[:-1]))[p]
                flat = np.stack((a + shift, z + shift), 1)
                cut = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[p[cut]]), pa.array(keys[p[cut]]),
                     pa.array([x.ravel() for x in np.split(flat, cut[1:])], pa.list_(pa.int64()))], ["doc_id", "row_key", "spans"])

    each = packed.select("batch", "ends", "ids", "keys", "offsets").join(gathered, "batch") \
        .mapInArrow(run, "doc_id long, row_key long, spans array<long>")
    return each.groupBy("doc_id", "row_key").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def remove_repeats(docs: DataFrame, length: int = 50, carry: tuple = ()) -> DataFrame:
    """doc_id, kept (binary), text, n_bytes, n_removed, n_spans, kept_sha256 and
    the columns named in ``carry``: one row per row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.xxhash64("doc_id", "text").alias("row_key"),
                       F.struct(*[F.col(c) for c in carry] or [F.lit(0).alias("none")]).alias("rest"))
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = saved(pack(rows.select("doc_id", "text", "row_key"), length))
    bits = repeated_minimizers(packed, length, shards)
    covered = covered_windows(packed, bits, length, shards)
    spans = _spans(packed, covered, length).select(F.col("doc_id").alias("of_id"), F.col("row_key").alias("of_key"), "spans")

    def run(batches):
        import pyarrow as pa

        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for b in in_small_batches(batches, 1 << 20, "z"):
            out = {c: [] for c in ("kept", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256")}
            for z, found in zip(b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True):
                text = unpack(z)
                merged: list = []
                flat = found or []
                for a, z in sorted(zip(flat[::2], flat[1::2])):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(z, merged[-1][1])
                    else:
                        merged.append([a, z])
                kept, at = [], 0
                for a, z in merged:
                    kept.append(text[at:a])
                    at = z
                kept = b"".join([*kept, text[at:]]) if merged else text
                out["kept"].append(kept)
                out["text"].append(kept.decode("utf-8", "ignore"))
                out["n_bytes"].append(len(text))
                out["n_removed"].append(len(text) - len(kept))
                out["n_spans"].append(len(merged))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(out["kept"], pa.binary()), pa.array(out["text"], pa.string()),
                 *(pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")),
                 pa.array(out["kept_sha256"], pa.string()), b.column(2)],
                ["doc_id", "kept", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256", "rest"])

    joined = _small(rows).join(spans, (F.col("doc_id") == F.col("of_id")) & (F.col("row_key") == F.col("of_key")), "left") \
        .select("doc_id", "z", "rest", "spans")
    done = joined.mapInArrow(run, "doc_id long, kept binary, text string, n_bytes long, n_removed long, n_spans long,"
                                  f" kept_sha256 string, rest {rows.schema['rest'].dataType.simpleString()}")
    return done.select("doc_id", "kept", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256",
                       *[F.col("rest")[c].alias(c) for c in carry])
