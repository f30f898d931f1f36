"""SimHash near-duplicates with bit-sliced comparison.

Fingerprint: a text is lower-cased (A-Z only) and cut into words (runs of other
bytes than 0x09-0x0D and 0x20); every shingle of ``shingle`` words, repeats
included, joined by single spaces (the whole sequence if there are fewer
words), is hashed by XXH64 with seed 42; bit k is set if over half of the
hashes have it. A text without words, empty or null, has fingerprint zero.

Linking: distinct fingerprints within ``radius`` bits are linked. Of
``radius + 2`` blocks of bits, two at least are equal in such a pair, so a
fingerprint goes to one bucket for each pair of blocks. Buckets of more than
``BLOCK`` fingerprints are cut into parts that meet pairwise in separate
tasks. In a task the fingerprints lie in bit planes, 64 to a word; a
carry-save counter of a few planes adds up the distances of 64 of them at
once, and the words in which all have passed the radius are given up.

Each task hands on a spanning forest of the links it finds, not the pairs;
connected components give each document the least doc_id that it reaches.

doc_id is the key: rows that repeat an id are documents with equal id. Rows
with null id are in the result with null component unless their fingerprint
has another row with an id. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import id_text_columns, in_small_batches, saved, utf8
from orrery.llm.components import components

BLOCK = 2048
SEED = 42


def word_blocks(text: bytes, size: int = 1 << 20):
    """Lists of the words of ``text``, about ``size`` bytes at a time."""
    if len(text) <= size:
        yield text.split()
        return
    import re

    at, space = 0, re.compile(rb"[\x09-\x0d\x20]")
    while at < len(text):
        m = space.search(text, min(at + size, len(text)))
        end = m.start() if m else len(text)
        yield text[at:end].split()
        at = end + 1


def shingle_hashes(text: bytes, k: int):
    """Arrays of the shingles' hashes; memory is bounded for any length."""
    from xxhash import xxh64_intdigest

    kept, n = [], 0
    for words in word_blocks(text.lower()):
        words = kept + words
        if len(words) >= k:
            joined, end = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
            start = (end - [len(w) + 1 for w in words]).tolist()
            end = (end - 1).tolist()
            yield np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(start, end[k - 1:])),
                              np.uint64, len(words) - k + 1)
            n += 1
        kept = words[max(0, len(words) - k + 1):] if k > 1 else []
    if not n and kept:
        yield np.array([xxh64_intdigest(b" ".join(kept), SEED)], np.uint64)


def fingerprints_of(texts: list, k: int, step: int = 1 << 15) -> np.ndarray:
    """Fingerprints (uint64) of the texts."""
    counts, total = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    held, owner, size = [], [], 0

    def add():
        h, o = np.concatenate(held), np.concatenate(owner)
        for at in range(0, len(h), step):
            part, mine = h[at:at + step], o[at:at + step]
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            first = np.flatnonzero(np.diff(mine, prepend=-1))
            counts[mine[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        held.clear()
        owner.clear()

    for i, t in enumerate(texts):
        for h in shingle_hashes(t or b"", k):
            held.append(h)
            owner.append(np.full(len(h), i))
            total[i] += len(h)
            size += len(h)
            if size > 4 * step:
                add()
                size = 0
    if held:
        add()
    bits = (2 * counts > total[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``; fp is the fingerprint as a signed long."""
    def run(batches):
        import pyarrow as pa

        for b in in_small_batches(batches, 2 << 20):
            fp = fingerprints_of(utf8(b.column(1)), shingle)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return id_text_columns(docs).mapInArrow(run, "doc_id long, fp long")


def bucket_masks(radius: int) -> list:
    """Masks of two of the radius + 2 blocks that the 64 bits are cut into."""
    edges = np.linspace(0, 64, radius + 3).round().astype(int).tolist()
    block = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [x | y for x, y in combinations(block, 2)]


def planes_of(fp: np.ndarray) -> np.ndarray:
    """(64, words): bit l of word w in plane k is bit k of fingerprint 64 w + l."""
    lanes = np.zeros(-(-len(fp) // 64) * 64, np.uint64)
    lanes[:len(fp)] = fp
    bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def near_lanes(planes: np.ndarray, fp: np.ndarray, query: np.ndarray, word: np.ndarray, radius: int):
    """For queries (indices into fp) each against one word of 64 lanes: the
    indices of the surviving ones and their masks of lanes within the radius."""
    n = int(radius).bit_length()
    at = np.arange(len(query))
    counter = [np.zeros(len(query), np.uint64) for _ in range(n)]
    over = np.zeros(len(query), np.uint64)
    full = ~np.uint64(0)
    mine, words = fp[query], word
    for k in range(64):
        # all ones where the query's bit is set
        x = planes[k][words] ^ (np.uint64(0) - ((mine >> np.uint64(k)) & np.uint64(1)))
        for c in counter:
            carry = c & x
            c ^= x
            x = carry
        over |= x
        if k >= 15 and k % 8 == 7:
            alive = np.flatnonzero(over != full)
            if len(alive) < 0.8 * len(over):
                at, over, mine, words = at[alive], over[alive], mine[alive], words[alive]
                counter = [c[alive] for c in counter]
                if not len(at):
                    break
    # counts above the radius that the counter can still hold
    for value in range(radius + 1, 1 << n):
        equal = ~over
        for i, c in enumerate(counter):
            equal &= c if value >> i & 1 else ~c
        over |= equal
    alive = np.flatnonzero(over != full)
    return at[alive], ~over[alive]


def forest(fp: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, radius: int, most: int = 1 << 18):
    """For each i the least index that i is linked to through links found here.
    Group g compares its own fingerprints [start, end) if middle == end, else
    [start, middle) with [middle, end)."""
    planes, root = planes_of(fp), np.arange(len(fp))
    lanes = np.arange(64)
    size = end - start
    group = np.repeat(np.arange(len(start)), size)
    i = np.arange(len(fp))
    lo = np.where(middle[group] == end[group], i + 1, middle[group])
    hi = end[group]
    ask = np.flatnonzero((lo < hi) & ((middle[group] == hi) | (i < middle[group])))
    n_words = (hi[ask] - 1) // 64 - lo[ask] // 64 + 1
    cuts = np.concatenate(([0], np.cumsum(n_words)))
    at = 0
    while at < len(ask):
        to = max(at + 1, int(np.searchsorted(cuts, cuts[at] + most, "right")) - 1)
        q = np.repeat(ask[at:to], n_words[at:to])
        word = lo[q] // 64 + np.arange(len(q)) - np.repeat(cuts[at:to] - cuts[at], n_words[at:to])
        alive, mask = near_lanes(planes, fp, q, word, radius)
        q, word = q[alive], word[alive]
        bits = np.unpackbits(mask.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(bool)
        j = word[:, None] * 64 + lanes
        bits &= (j >= lo[q][:, None]) & (j < hi[q][:, None])
        row, col = np.nonzero(bits)
        u, v = q[row], j[row, col]
        while len(u):  # hook the larger root to the smaller, then shorten paths
            a, b = root[u], root[v]
            differ = a != b
            u, v, a, b = u[differ], v[differ], a[differ], b[differ]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root != (up := root[root])).any():
                root = up
        at = to
    return root


def links(nodes: DataFrame, radius: int = 3, block: int = BLOCK) -> DataFrame:
    """(u, v): a spanning forest of the links of each bucket, in ids, of
    distinct fingerprints (fp, id)."""
    def signed(mask):
        return mask - (1 << 64) if mask >> 63 else mask

    masks = bucket_masks(radius)
    keyed = nodes.where("id is not null").select(
        "fp", "id", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(signed(m))) for m in masks])).alias("t", "key"))
    size = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / block).cast("int")
    mine = F.pmod(F.xxhash64("fp"), parts).cast("int")
    dealt = keyed.join(size, ["t", "key"]).select("t", "key", "fp", "id", mine.alias("mine"), F.explode(
        F.sequence(F.lit(0), parts - 1)).alias("other")).select(
        "t", "key", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"),
        (F.col("mine") > F.col("other")).alias("second"), "fp", "id")
    keys = ["t", "key", "p", "q"]

    def run(batches):
        import pyarrow as pa

        def pieces():
            held, rows = [], 0
            for b in batches:
                held.append(b)
                rows += b.num_rows
                if rows >= 1 << 16:
                    t = pa.Table.from_batches(held)
                    # the last group may go on in the next batch
                    cut = np.flatnonzero(changes(t))
                    if len(cut) > 1:
                        yield t.slice(0, int(cut[-1]))
                        t = t.slice(int(cut[-1]))
                    held, rows = t.to_batches(), t.num_rows
            if rows:
                yield pa.Table.from_batches(held)

        def changes(t):
            new = np.zeros(t.num_rows, bool)
            new[0] = True
            for c in keys:
                x = t.column(c).to_numpy()
                new[1:] |= x[1:] != x[:-1]
            return new

        for t in pieces():
            start = np.flatnonzero(changes(t))
            end = np.append(start[1:], t.num_rows)
            second = t.column("second").to_numpy(zero_copy_only=False)
            cross = (t.column("p").to_numpy() != t.column("q").to_numpy())[start]
            middle = np.where(cross, end - np.add.reduceat(second.astype(np.int64), start), end)
            fp = t.column("fp").to_numpy().view(np.uint64)
            ids = t.column("id").to_numpy()
            root = forest(fp, start, middle, end, radius)
            linked = np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(ids[root[linked]])], ["u", "v"])

    return dealt.repartition(*keys).sortWithinPartitions(*keys, "second").mapInArrow(run, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits), component_id (least
    doc_id reached): one row per row of ``docs``."""
    fps = saved(fingerprints(docs, shingle))
    nodes = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("id")))
    root = components(links(nodes, radius))
    placed = nodes.join(root, nodes["id"] == root["node"], "left") \
        .select("fp", F.coalesce("root", "id").alias("component_id"))
    return fps.join(placed, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
