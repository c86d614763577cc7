"""Near-duplicate records with small edits.

Order MinHash: words are grouped to k-mers (three consecutive words) labelled with their occurrence; each of ``SKETCHES``
samples takes the ``ORDERED`` labelled k-mers with the smallest hashes and hashes them, ``IN_ORDER`` samples in the order in
which the text has them. The others leave order and labels out: the result asked for is a similarity of sets, and of records whose
sentences were reordered, samples in text order alone miss most. Records that share a sample are candidates. Verification has three
steps: a bitmap of each record's k-mers bounds what two records can share, and never too low, so pairs below the threshold go before
any text is fetched; the k-mers of the rest are aligned within a band (longest common subsequence, bit-parallel), and what is aligned
is shared; pairs whose alignment doesn't reach the threshold, as parts were moved, get the exact count of shared k-mers.

A pair at the threshold of 0.5 shares one sample with probability 1/16 and one of 60 to 68 with 98 to 99 %; at 0.6 with 99.98 %.
Unrelated texts of a corpus share about 0.005, to the fourth power.

Sizes. One map over the texts, without a shuffle of them, gives every record its class (a hash of its words) and, once a task for each
class, its samples and bitmap; so a third of all rows may be copies of each other. Keys of samples and classes are joined by a
sort-merge self-join that AQE may split; no group is collected. A candidate costs two bitmaps of about half a byte a word. Texts are read
again only for the classes in pairs that the bound lets through.

Output forms. Links hold between all members of two classes. Classes of up to ``EXPANDED`` members, with ``all_pairs`` of any size, are written out as pairs; of a larger class all members are linked to its smallest id, which stands for them in other links: nothing is lost, but
a class of a million copies isn't written as 10^12 pairs unless asked for.

Defined cases: null texts and texts of fewer than 20 words take no part; rows sent twice count once; rows with a null id are
left out; the two tables are never compared with each other; class identity is a 64-bit hash of the words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import M3, WordHash, mix, words_of
from foliant.runtime import materialize

#: Words of a k-mer; samples that keep text order, all samples; k-mers of a sample.
KMER, IN_ORDER, SKETCHES, ORDERED = 3, 8, 68, 4
MIN_WORDS, THRESHOLD = 20, 0.5
#: Places by which aligned k-mers may be apart; the largest class whose copies are written out as pairs.
BAND, EXPANDED = 64, 64
#: Bits of a bitmap for each k-mer, at least.
SPARSE = 4
SKETCHED = "table_name string, id bigint, class bigint, n int, bits binary, keys array<bigint>"
PAIRS = "table_name string, id_a bigint, id_b bigint, a bigint, b bigint, similarity double, alignment double, how string"
_rng = np.random.default_rng(20)
_MUL = _rng.integers(1, 2**32, SKETCHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_ROWS, _NONE = np.arange(SKETCHES), np.uint32(0xFFFFFFFF)


def kmers(words: list[str], known: WordHash) -> tuple[np.ndarray, np.ndarray | None]:
    """Hashes of the consecutive words, each labelled with its occurrence in the text, and which of them occurred before (none: no one)."""
    w = known.hashes(words)
    m = len(w) - KMER + 1
    if m < 1:
        return np.zeros(0, np.uint64), None
    h = w[:m]
    for k in range(1, KMER):
        h = mix(h * M3 + w[k : k + m])
    s = np.sort(h)
    if (s[1:] != s[:-1]).all():
        return h, None
    order, at = np.argsort(h, kind="stable"), np.arange(m)
    s = h[order]
    new = np.concatenate(([True], s[1:] != s[:-1]))
    nth = np.empty(m, np.uint64)
    nth[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    again = nth > 0
    return np.where(again, mix(h + nth * M3), h), again


def sketch(h: np.ndarray, again: np.ndarray | None = None) -> np.ndarray:
    """One key for each sample: its smallest k-mers, hashed in text order or, for the order-free samples, by size.

    Samples in text order take labelled k-mers; the others each k-mer once, as the similarity is one of sets. The order of a sample is
    that of the hashes times its own odd number. Where a text has fewer k-mers, the rest of the key is empty.
    """
    x = (h >> np.uint64(32)).astype(np.uint32)[None, :] * _MUL[:, None]
    if again is not None:
        x[IN_ORDER:, again] = _NONE
    places, full = np.empty((SKETCHES, ORDERED), np.int64), np.empty((SKETCHES, ORDERED), bool)
    for k in range(ORDERED):
        places[:, k] = at = x.argmin(axis=1)
        full[:, k] = x[_ROWS, at] != _NONE
        x[_ROWS, at] = _NONE
    own = np.where(full, h[places], np.uint64(0))
    order = np.argsort(places[:IN_ORDER], axis=1)
    own[:IN_ORDER] = np.take_along_axis(own[:IN_ORDER], order, 1)
    key = _ROWS.astype(np.uint64) + np.uint64(1)
    for k in range(ORDERED):
        key = (key ^ (key >> np.uint64(29))) * M3 + own[:, k]
    return mix(key)


def bitmap(h: np.ndarray) -> bytes:
    """A bit for each k-mer in a map of at least ``SPARSE`` bits a k-mer; maps of two sizes meet by folding the larger one."""
    size = 1 << max(10, int(SPARSE * len(h) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(h & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def most_shared(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Bounds from above how many k-mers the records of each row can share: bits set in both maps, and what may be hidden behind an equal bit."""
    ones = lambda x: np.bitwise_count(np.ascontiguousarray(x).view(np.uint64)).sum(axis=1).astype(np.int64)
    while a.shape[1] > b.shape[1]:
        a = a[:, : a.shape[1] // 2] | a[:, a.shape[1] // 2 :]
    while b.shape[1] > a.shape[1]:
        b = b[:, : b.shape[1] // 2] | b[:, b.shape[1] // 2 :]
    return ones(a & b) + np.minimum(na - ones(a), nb - ones(b))


def enough(shared, na, nb, threshold: float = THRESHOLD):
    """Whether so many shared k-mers are ``threshold`` of the union."""
    return shared * (1 + threshold) >= threshold * (na + nb) - 1e-9


def similarity(a: list[str], b: list[str]) -> float:
    """Intersection over union of the sets of consecutive words."""
    x, y = (set(zip(*(w[k:] for k in range(KMER)))) for w in (a, b))
    both = len(x & y)
    return both / (len(x) + len(y) - both) if x or y else 0.0


def aligned(a: list, b: list, band: int = BAND) -> int:
    """Longest common subsequence, matches at most ``band`` places apart."""
    if not a or not b:
        return 0
    at: dict = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    n, full = len(a), (1 << len(a)) - 1
    v, wide = full, (1 << (2 * band + 1)) - 1
    for j, w in enumerate(b):
        m = at.get(w, 0)
        if not m:
            continue
        lo = j * n // len(b) - band
        u = v & m & (wide << lo if lo > 0 else wide >> -lo)
        v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def alignment(a: list, b: list, band: int = BAND) -> float:
    """What is aligned, over the longer of both."""
    return aligned(a, b, band) / max(len(a), len(b)) if a and b else 0.0


def class_of(table: str, words: list[str]) -> int:
    """Identity of a record's words within its table, as a signed number."""
    import xxhash

    h = xxhash.xxh64_intdigest(table + "\n" + " ".join(words))
    return h - (1 << 64) if h >> 63 else h


def _sketches(batches):
    """A row for each record; samples and bitmap once for each class of a task (a task forgets the classes it has seen beyond a million)."""
    known, seen = WordHash(), set()
    for b in batches:
        ids, tables, classes, n, bits, keys, full = [], [], [], [], [], [], [0]
        for table, i, text in zip(*(b.column(x).to_pylist() for x in ("table_name", "id", "text"))):
            words = words_of(text)
            if len(words) < MIN_WORDS:
                continue
            c = class_of(table, words)
            tables.append(table)
            ids.append(i)
            classes.append(c)
            if c in seen:
                n.append(None)
                bits.append(None)
                full.append(full[-1])
                continue
            if len(seen) >= 1_000_000:
                seen.clear()
            seen.add(c)
            h, again = kmers(words, known)
            own = h if again is None else h[~again]
            n.append(len(own))
            bits.append(bitmap(own))
            keys.append(mix(sketch(h, again) ^ known.hashes([table])).view(np.int64))
            full.append(full[-1] + SKETCHES)
        lists = pa.ListArray.from_arrays(pa.array(full, pa.int32()), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
        yield pa.record_batch([pa.array(tables, pa.string()), pa.array(ids, pa.int64()), pa.array(classes, pa.int64()), pa.array(n, pa.int32()), pa.array(bits, pa.binary()), lists], names=[f.split()[0] for f in SKETCHED.split(", ")])


def _bounded(threshold: float):
    def run(batches):
        for b in batches:
            na, nb = (b.column(c).to_numpy().astype(np.int64) for c in ("n_a", "n_b"))
            maps = [b.column(c).to_pylist() for c in ("bits_a", "bits_b")]
            sizes = np.array([[len(x) for x in m] for m in maps], np.int64).reshape(2, -1)
            keep = np.zeros(b.num_rows, bool)
            for la, lb in {(x, y) for x, y in sizes.T.tolist()}:
                at = np.flatnonzero((sizes[0] == la) & (sizes[1] == lb))
                x, y = (np.frombuffer(b"".join([m[i] for i in at.tolist()]), np.uint8).reshape(len(at), -1) for m in maps)
                keep[at] = enough(most_shared(x, y, na[at], nb[at]), na[at], nb[at], threshold)
            yield b.select(["a", "b"]).filter(pa.array(keep))

    return run


def _verify(threshold: float):
    names = [f.split()[0] for f in PAIRS.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string()]

    def run(batches):
        known, last = WordHash(), {}

        def own(table, c, text):
            """First occurrences of the k-mers of a text, or none if the text isn't of the class."""
            if c not in last:
                words = words_of(text)
                if class_of(table, words) != c:
                    return None
                if len(last) >= 256:
                    last.clear()
                h, again = kmers(words, known)
                h = (h if again is None else h[~again]).tolist()
                last[c] = h, set(h)
            return last[c]

        for b in batches:
            rows = []
            for table, ia, ib, ca, cb, ta, tb in zip(*(b.column(x).to_pylist() for x in ("table_name", "id_a", "id_b", "a", "b", "text_a", "text_b"))):
                left, right = own(table, ca, ta), own(table, cb, tb)
                if not left or not right:
                    continue
                (x, sx), (y, sy) = left, right
                line, both = aligned(x, y), len(sx & sy)
                how = "aligned" if enough(line, len(x), len(y), threshold) else "moved" if enough(both, len(x), len(y), threshold) else None
                if how:
                    rows.append((table, ia, ib, ca, cb, round(both / (len(x) + len(y) - both), 6), round(line / max(len(x), len(y)), 6), how))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types)], names=names)

    return run


def records(content: DataFrame, chunks: DataFrame) -> DataFrame:
    """Both tables as ``table_name, id, text``; a text of 20 words has at least 39 characters."""
    both = content.select(F.lit("document_content").alias("table_name"), F.col("section_id").alias("id"), F.col("content_text").alias("text")).unionByName(
        chunks.select(F.lit("embedding_table").alias("table_name"), F.col("chunk_id").alias("id"), F.col("chunk_text").alias("text"))
    )
    return both.where(F.col("id").isNotNull() & (F.length("text") >= 2 * MIN_WORDS - 1))


def sketched(rows: DataFrame) -> DataFrame:
    """:data:`SKETCHED` of the records, written once: everything but the last step reads it instead of the texts."""
    return materialize(rows.mapInArrow(_sketches, SKETCHED), "p4-sketched")


def members(sketches: DataFrame) -> DataFrame:
    """``table_name, class, id, n, rep``: every record with the size of its class and its smallest id."""
    ids = sketches.select("table_name", "class", "id").distinct()
    return materialize(ids.join(ids.groupBy("class").agg(F.count("*").alias("n"), F.min("id").alias("rep")), "class"), "p4-members")


def class_links(rows: DataFrame, sketches: DataFrame, all_ids: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links between the representatives of classes (:data:`PAIRS`)."""
    full = sketches.where("bits is not null")
    keys = full.select(F.explode("keys").alias("key"), "class")
    near = keys.withColumnRenamed("class", "a").join(keys.withColumnRenamed("class", "b"), "key").where("a < b").select("a", "b").distinct()
    maps = full.groupBy("class").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
    side = lambda x: maps.select(F.col("class").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    left = materialize(near.join(side("a"), "a").join(side("b"), "b").mapInArrow(_bounded(threshold), "a bigint, b bigint"), "p4-bounded")
    wanted = materialize(left.select(F.col("a").alias("class")).unionByName(left.select(F.col("b").alias("class"))).distinct().join(all_ids.where("id = rep"), "class").select("class", "table_name", "id"), "p4-wanted")
    texts = rows.join(wanted, ["table_name", "id"]).select("class", "table_name", "id", "text").distinct()
    first = texts.select(F.col("class").alias("a"), "table_name", F.col("id").alias("id_a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("class").alias("b"), F.col("id").alias("id_b"), F.col("text").alias("text_b"))
    found = left.join(first, "a").join(second, "b").select("table_name", "id_a", "id_b", "a", "b", "text_a", "text_b").mapInArrow(_verify(threshold), PAIRS)
    return materialize(found.distinct(), "p4-links")


def pairs(content: DataFrame, chunks: DataFrame, all_pairs: bool = False) -> DataFrame:
    """``table_name, id_a, id_b``, a < b, of records whose similarity is at least one half; classes of over ``EXPANDED`` records as stars unless ``all_pairs``."""
    rows = records(content, chunks)
    sketches = sketched(rows)
    all_ids = members(sketches)
    links = class_links(rows, sketches, all_ids)
    small, large = (F.lit(True), F.lit(False)) if all_pairs else (F.col("n") <= EXPANDED, F.col("n") > EXPANDED)
    # who takes part in pairs: all of a small class, the representative of a large one
    out = all_ids.where(small | (F.col("id") == F.col("rep")))
    a = out.select(F.col("class").alias("a"), F.col("id").alias("x"))
    b = out.select(F.col("class").alias("b"), F.col("id").alias("y"))
    between = links.select("table_name", "a", "b").join(a, "a").join(b, "b").select("table_name", "x", "y")
    twice = materialize(all_ids.where("n > 1"), "p4-copies")
    few = twice.where(small)
    within = few.select("table_name", "class", F.col("id").alias("x")).join(few.select("class", F.col("id").alias("y")), "class").where("x < y").select("table_name", "x", "y")
    star = twice.where(large & (F.col("id") != F.col("rep"))).select("table_name", F.col("rep").alias("x"), F.col("id").alias("y"))
    every = between.unionByName(within).unionByName(star)
    return every.select("table_name", F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that each node of ``a, b`` is connected to.

    In each round a node adopts the smallest label at its links, its old label (the root of its tree) is hooked to the smallest
    label that any of its nodes adopts, and all jump to their label's label, until nothing changes. Trees merge as wholes, so rounds
    grow with the logarithm of a chain's length; each round is written, so a lost executor costs one round.
    """
    both = materialize(edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct(), "cc-edges")
    label = materialize(both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("root")), "cc-label")
    while True:
        spread = both.join(label.select(F.col("node").alias("other"), "root"), "other").groupBy("node").agg(F.min("root").alias("seen"))
        adopted = label.join(spread, "node").select("node", "root", F.least("root", "seen").alias("seen"))
        # labels are nodes; a label's own row takes what any of its nodes has seen
        hooks = adopted.groupBy(F.col("root").alias("node")).agg(F.min("seen").alias("hook"))
        hooked = materialize(adopted.join(hooks, "node", "left").select("node", F.col("root").alias("old"), F.least("seen", "hook").alias("root")), "cc-hook")
        jump = hooked.select(F.col("node").alias("root"), F.col("root").alias("next"))
        new = materialize(hooked.join(jump, "root").select("node", F.least("root", "next").alias("root"), "old"), "cc-label")
        label = new.select("node", "root")
        if new.where("root <> old").isEmpty():
            return label


def groups(content: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row per record of a group: ``table_name, id, group_id`` (the smallest id in it), ``links`` (classes its class is linked to), ``copies`` (records of its class)."""
    rows = records(content, chunks)
    sketches = sketched(rows)
    all_ids = members(sketches)
    links = class_links(rows, sketches, all_ids).select("a", "b")
    root = components(links)
    degree = links.select(F.col("a").alias("class")).unionByName(links.select(F.col("b").alias("class"))).groupBy("class").agg(F.count("*").alias("links"))
    joined = all_ids.join(degree, "class", "left").join(root.withColumnRenamed("node", "class"), "class", "left").where("n > 1 or links is not null").withColumn("root", F.coalesce("root", "class"))
    joined = materialize(joined.select("table_name", "id", "root", F.coalesce("links", F.lit(0)).alias("links"), F.col("n").alias("copies")), "p4-joined")
    return joined.join(joined.groupBy("root").agg(F.min("id").alias("group_id")), "root").select("table_name", "id", "group_id", "links", "copies")


def links(content: DataFrame, chunks: DataFrame) -> DataFrame:
    """``table_name, id_a, id_b, similarity, alignment, how`` between the smallest ids of classes; ``how``: the pair was verified by its alignment, or parts were moved."""
    rows = records(content, chunks)
    sketches = sketched(rows)
    out = class_links(rows, sketches, members(sketches))
    return out.select("table_name", F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), "similarity", "alignment", "how")
