"""Source filters, resume, embeddings, exact nearest neighbours and search terms."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.stem import stem_word
from foliant.functions.text import is_blank, row_text

BATCH = 64
#: Vectors of a query block held in memory at once (16 MB at 64 values).
BLOCK = 65_536
#: English words that never become search terms.
STOP_WORDS = (
    "a about above after again against all am an and any are as at be because been before being below between both but by can did do does doing don down during each few "
    "for from further had has have having he her here hers herself him himself his how i if in into is it its itself just me more most my myself no nor not now of off on "
    "once only or other our ours ourselves out over own s same she should so some such t than that the their theirs them themselves then there these they this those through "
    "to too under until up very was we were what when where which while who whom why will with you your yours yourself yourselves"
).split()


def source_filter(df: DataFrame, patterns: dict[str, str | list[str]]) -> Column:
    """LIKE patterns: any of a column's, all columns; a null never matches. Unknown columns are an error."""
    unknown = sorted(set(patterns) - set(df.columns))
    if unknown:
        raise ValueError(f"unknown columns {unknown}; there are {sorted(df.columns)}")
    any_of = [reduce(lambda a, b: a | b, [F.col(c).cast("string").like(p) for p in ([v] if isinstance(v, str) else v)]) for c, v in patterns.items()]
    return F.coalesce(reduce(lambda a, b: a & b, any_of, F.lit(True)), F.lit(False))


def has_text(columns: list[str]) -> Column:
    """Whether any of the columns is more than blank."""
    return reduce(lambda a, b: a | b, [~is_blank(F.col(c).cast("string")) for c in columns])


def resume(source: DataFrame, done: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Source rows without a result yet; keys map source columns to result columns. A left anti join."""
    have = done.select(*[F.col(b).alias(a) for a, b in keys.items()]).distinct()
    return source.join(have, list(keys), "left_anti")


def surviving(results: DataFrame, source: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Results that an overwrite of the given source rows leaves in place."""
    gone = source.select(*[F.col(a).alias(b) for a, b in keys.items()]).distinct()
    return results.join(gone, list(keys.values()), "left_anti")


def embed_text(columns: list[str]) -> Column:
    """``column: value`` lines."""
    return row_text([(c, c) for c in columns])


def hashed_vector(text: str, dim: int) -> np.ndarray:
    """A reproducible stand-in for a model: words hashed to signed dimensions, of length one."""
    import xxhash

    v = np.zeros(dim, np.float32)
    for w in text.lower().split():
        h = xxhash.xxh64_intdigest(w)
        v[h % dim] += 1 if h >> 63 else -1
    norm = float(np.sqrt((v * v).sum()))
    return v / norm if norm else v


def hashed_model(dim: int = 64) -> Callable[[], Callable[[list[str]], np.ndarray]]:
    return lambda: lambda texts: np.stack([hashed_vector(t, dim) for t in texts]) if texts else np.zeros((0, dim), np.float32)


def hashed_words() -> Callable[[list[str]], np.ndarray]:
    """The stand-in as a hook: a model of 64 values."""
    return hashed_model()()


def encode(chunks: DataFrame, make_model: Callable[[], Callable[[list[str]], np.ndarray]] | None = None, batch: int = BATCH) -> DataFrame:
    """Adds ``embedding``: the model is made once a task and given batches of texts."""
    make = make_model or hashed_model()
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chunks.schema) + ", embedding array<float>"

    def run(batches):
        model = make()
        for b in batches:
            texts = [t or "" for t in b.column("chunk_text").to_pylist()]
            parts = [model(texts[i : i + batch]) for i in range(0, len(texts), batch)]
            vectors = np.concatenate(parts) if parts else np.zeros((0, 1), np.float32)
            dim = vectors.shape[1]
            offsets = pa.array(np.arange(0, (len(texts) + 1) * dim, dim), pa.int32())
            column = pa.ListArray.from_arrays(offsets, pa.array(vectors.reshape(-1).astype(np.float32))) if len(texts) else pa.array([], pa.list_(pa.float32()))
            yield pa.record_batch([*b.columns, column], names=[*b.schema.names, "embedding"])

    return chunks.mapInArrow(run, schema)


def terms(text: str | Column) -> Column:
    """Search terms of an English text: words less stop words, stemmed, distinct and sorted. The stems are Porter's."""

    @F.pandas_udf("array<string>")
    def stems(s):
        known: dict[str, str] = {}
        return s.map(lambda ws: sorted({known.get(w) or known.setdefault(w, stem_word(w)) for w in ws}) if ws is not None else [])

    c = F.col(text) if isinstance(text, str) else text
    found = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)))
    return stems(F.filter(found, lambda w: ~w.isin(STOP_WORDS)))


def vector_checks(df: DataFrame, column: str, dim: int) -> DataFrame:
    """One row: rows, null vectors, vectors of another size."""
    v = F.col(column)
    return df.agg(F.count("*").alias("n"), F.count_if(v.isNull()).alias("n_null"), F.count_if(F.size(v) != dim).alias("n_other_size"))


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, n, out=np.zeros_like(x), where=n > 0)


def _block_top(shared, k: int, dim: int):
    names = ["query_id", "id", "similarity"]

    def run(batches):
        ids, q = shared.value
        best_s = np.full((len(ids), k), -np.inf)
        best_i = np.full((len(ids), k), np.iinfo(np.int64).max)
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                other = part.column("id").to_numpy()
                x = _unit(part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64))
                for lo in range(0, len(ids), 2048):
                    s = np.round(q[lo : lo + 2048] @ x.T, 6)
                    s[ids[lo : lo + 2048, None] == other[None, :]] = -np.inf
                    cs = np.concatenate([best_s[lo : lo + 2048], s], 1)
                    ci = np.concatenate([best_i[lo : lo + 2048], np.broadcast_to(other, s.shape)], 1)
                    order = np.lexsort((ci, -cs), axis=1)[:, :k]
                    best_s[lo : lo + 2048], best_i[lo : lo + 2048] = np.take_along_axis(cs, order, 1), np.take_along_axis(ci, order, 1)
        ok = np.isfinite(best_s)
        yield pa.record_batch([pa.array(np.repeat(ids, ok.sum(axis=1))), pa.array(best_i[ok]), pa.array(best_s[ok])], names=names)

    return run


def top_k(rows: DataFrame, queries: DataFrame, id_col: str, vector: str, dim: int, k: int = 5) -> DataFrame:
    """Exact cosine neighbours of a stated query set: ``query_id, rank, id, similarity`` (6 digits; ties by id).

    Queries are taken in blocks of :data:`BLOCK` vectors; each block is broadcast and meets every row in one pass, in which a task keeps only k
    rows for a query. Vectors of another size or null take no part.
    """
    spark = rows.sparkSession
    fit = lambda d: d.where((F.size(vector) == dim) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(vector).alias("vector"))
    every, asked = fit(rows), fit(queries)
    n_blocks = max(1, -(-asked.count() // (BLOCK // 2)))
    out = None
    for j in range(n_blocks):
        t = asked.where(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == j).toArrow()
        ids = t.column("id").to_numpy()
        q = _unit(np.array(t.column("vector").to_pylist(), np.float64).reshape(-1, dim))
        part = every.mapInArrow(_block_top(spark.sparkContext.broadcast((ids, q)), k, dim), "query_id bigint, id bigint, similarity double")
        out = part if out is None else out.unionByName(part)
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("similarity")).alias("d"), F.col("id")))), 1, k)
    return out.groupBy("query_id").agg(best.alias("b")).select("query_id", F.posexplode("b").alias("pos", "x")).select("query_id", (F.col("pos") + 1).alias("rank"), F.col("x.id").alias("id"), (-F.col("x.d")).alias("similarity"))


def token_gate(df: DataFrame, text: str, words: str, longest: int, budget: int, special: int = 2) -> DataFrame:
    """One row: chunks, the most tokens, chunks over the model's length, chunks over the budget that could (more than one word) or could not be split."""
    from foliant.functions.text import word_count

    shown = df.select(word_count(text).alias("n"), F.col(words).alias("stored")).withColumn("tokens", F.col("n") + special)
    over = F.col("tokens") > budget
    return shown.agg(
        F.count("*").alias("n_chunks"), F.coalesce(F.max("tokens"), F.lit(0)).alias("most_tokens"), F.count_if(F.col("tokens") > longest).alias("n_over_model"), F.count_if(over & (F.col("stored") > 1)).alias("n_over_budget"), F.count_if(over & (F.col("stored") <= 1)).alias("n_single_over")
    )
