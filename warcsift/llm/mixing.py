"""Operator 2: mixing sources to target weights by a multivariate-hypergeometric
splitting tree.

1. Sources share ``share`` x all words by weight; a target stops at ``cap`` x
   its source's words, the excess is reshared (``targets``; one row a source).
2. A source's documents are dealt by hash over blocks: one per ``BLOCK_DOCS``
   documents, at most ``MAX_BLOCKS``, so that a hot source has many. Whole
   passes take every block; the rest of the target takes blocks in a permuted
   order, and of the last block the documents that fill what is left.
3. These block quotas, exact per source, are split recursively between the
   halves of the output shards by multivariate-hypergeometric draws
   (``split_quotas``); a shard takes the next blocks of each source's order, so
   the draws are disjoint; it is shuffled locally by a hash.

Only source totals and quotas (sources x shards numbers) pass through the
driver. Block tables hold at most ``MAX_BLOCKS`` rows a source and pass.

Defined results: null text has size 0; a null source is a source of its own,
last in order; rows with equal doc_id, source and size are taken together; a
null doc_id is an id like any other; an empty table gives an empty result;
other columns are carried along (``mix``) or not read (``plan_mix``).
Results depend on the rows alone, so reruns agree.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialise, text_of, words

WEIGHTS, SHARE, CAP = (3, 1, 2), 1.5, 2.0
BLOCK_DOCS, MAX_BLOCKS, SEED = 256, 65_536, 20_240


@dataclass
class Mix:
    """``docs`` (doc_id, source, size, sid, block, source_size, target),
    ``units`` (sid, block, pass, rank, shard; whole blocks), ``border`` (sid,
    border_id, border_size, pass, shard; documents of last blocks)."""

    docs: DataFrame
    units: DataFrame
    border: DataFrame
    plan: DataFrame


def size_of(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def targets(sizes: list[int], weights: list[float], share: float = SHARE, cap: float = CAP) -> list[float]:
    """``share`` of all sizes by weight, none above ``cap`` x its size."""
    out, free = [0.0] * len(sizes), set(range(len(sizes)))
    left = share * sum(sizes)
    while free:
        total = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / total > cap * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = cap * sizes[i]
        left -= sum(out[i] for i in over)
        free.difference_update(over)
    return out


def split_quotas(quotas: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """shards x sources block counts: rows of near-equal sums, columns summing to ``quotas``."""
    total = int(quotas.sum())
    ends = [round(total * k / shards) for k in range(shards + 1)]
    out = np.zeros((shards, len(quotas)), dtype=np.int64)

    def split(lo: int, hi: int, pot: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = pot
            return
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        left = _draw(rng, pot, ends[mid] - ends[lo])
        split(lo, mid, left)
        split(mid, hi, pot - left)

    split(0, shards, quotas.astype(np.int64))
    return out


def _draw(rng: np.random.Generator, pot: np.ndarray, n: int) -> np.ndarray:
    """A multivariate-hypergeometric draw, source by source from its marginals."""
    out, rest = np.zeros_like(pot), int(pot.sum())
    for i, have in enumerate(pot.tolist()):
        rest -= have
        out[i] = rng.hypergeometric(have, rest, n) if n and have else 0
        n -= int(out[i])
    return out


def _blocks(plan: DataFrame, docs: DataFrame, columns: list[str], source: str, doc_id: str, size: str) -> DataFrame:
    """``docs`` joined with its source's row of ``plan``, and its block."""
    names = {"source": "plan_source"}
    joined = docs.join(plan.withColumnsRenamed(names), docs[source].eqNullSafe(F.col("plan_source")))
    block = F.pmod(F.xxhash64(F.lit(SEED), doc_id, size), F.col("blocks")).cast("int")
    return joined.select(*columns, "sid", block.alias("block"), "source_size", "target")


def plan_mix(sized: DataFrame, shards: int = 16, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> Mix:
    """Decide what is taken. ``sized``: doc_id, source, size; read several times."""
    spark = sized.sparkSession
    rows = (sized.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
            .orderBy(F.asc_nulls_last("source")).collect())  # one row a source
    sizes = [int(r["words"]) for r in rows]
    goal = targets(sizes, [float(weights[i % len(weights)]) for i in range(len(rows))], share, cap)
    plan = spark.createDataFrame(
        [(i, r["source"], s, t, int(min(MAX_BLOCKS, max(1, r["docs"] // BLOCK_DOCS))))
         for i, (r, s, t) in enumerate(zip(rows, sizes, goal, strict=True))],
        "sid int, source string, source_size long, target double, blocks int")
    docs = _blocks(plan, sized, ["doc_id", "source", "size"], "source", "doc_id", "size")

    def order(pdf: pd.DataFrame) -> pd.DataFrame:
        """The units a source takes, in order; ``left`` words are wanted of the last."""
        sid, have, want = int(pdf["sid"].iloc[0]), int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        pdf = pdf.sort_values("block").reset_index(drop=True)
        whole = int(want // have) if have else 0
        out = []
        for p in range(whole + 1):
            shuffled = pdf.iloc[np.random.default_rng([SEED, sid, p]).permutation(len(pdf))]
            if p < whole:
                out.append(pd.DataFrame({"block": shuffled["block"], "pass": p, "left": np.nan}))
                continue
            before = shuffled["words"].cumsum() - shuffled["words"]
            left = want - whole * have - before
            taken = (left > 0) & (shuffled["words"] > 0)
            part = pd.DataFrame({"block": shuffled["block"], "pass": p, "left": left})[taken]
            part.loc[part["left"] >= shuffled["words"][taken], "left"] = np.nan
            out.append(part)
        units = pd.concat(out)
        units["sid"], units["rank"] = sid, np.arange(len(units))
        return units[["sid", "block", "pass", "rank", "left"]].astype({"rank": "int64"})

    blocks = docs.groupBy("sid", "block", "source_size", "target").agg(F.sum("size").alias("words"))
    units = materialise(blocks.groupBy("sid").applyInPandas(
        order, "sid int, block int, pass int, rank long, left double"), "mix-units")
    quota = {r["sid"]: r["n"] for r in units.groupBy("sid").agg(F.count("*").alias("n")).collect()}
    ends = split_quotas(np.array([quota.get(i, 0) for i in range(len(rows))], dtype=np.int64), shards).cumsum(axis=0)

    def to_shard(batches):
        for pdf in batches:
            pdf["shard"] = [int(np.searchsorted(ends[:, s], r, side="right")) for s, r in zip(pdf["sid"], pdf["rank"], strict=True)]
            yield pdf

    placed = units.mapInPandas(to_shard, "sid int, block int, pass int, rank long, left double, shard int")
    last = placed.filter("left IS NOT NULL AND NOT isnan(left)").select("sid", "block", "pass", "shard", "left")
    items = (docs.join(last, ["sid", "block"]).groupBy("sid", "doc_id", "size", "pass", "shard", "left")
             .agg(F.sum("size").alias("words")))
    border = items.groupBy("sid").applyInArrow(_fill, "sid int, border_id long, border_size long, pass int, shard int")
    return Mix(docs, placed.filter("left IS NULL OR isnan(left)").select("sid", "block", "pass", "shard"),
               materialise(border, "mix-border"), plan)


def _fill(rows: pa.Table) -> pa.Table:
    """Documents of one block, in a permuted order, that best fill ``left`` words."""
    rows = rows.sort_by([("doc_id", "ascending"), ("size", "ascending")])
    words = rows["words"].to_numpy()
    left = float(rows["left"][0].as_py())
    chosen = np.zeros(len(words), dtype=bool)
    for i in np.random.default_rng([SEED, rows["sid"][0].as_py(), 9]).permutation(len(words)):
        if words[i] <= left:
            chosen[i] = True
            left -= float(words[i])
    rest = np.flatnonzero(~chosen & (words < 2 * left))
    if len(rest):  # one more comes nearer
        chosen[rest[np.abs(words[rest] - left).argmin()]] = True
    return (rows.filter(pa.array(chosen)).select(["sid", "doc_id", "size", "pass", "shard"])
            .rename_columns(["sid", "border_id", "border_size", "pass", "shard"]))


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size``, read from the texts once and written."""
    return materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                                   size_of(text_of()).alias("size")), "mix-sizes")


def _on_border(docs: DataFrame, border: DataFrame, doc_id: str, size: str):
    return (docs["sid"] == border["sid"]) & docs[doc_id].eqNullSafe(border["border_id"]) & (docs[size] == border["border_size"])


def taken(mix: Mix) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, shards`` (the
    output shard of every time it is taken, ascending)."""
    whole = mix.units.groupBy("sid", "block").agg(F.collect_list("shard").alias("whole"))  # one a pass
    border = mix.border.select("sid", "border_id", "border_size", F.array("shard").alias("once"))
    docs = mix.docs.join(whole, ["sid", "block"], "left")
    both = docs.join(border, _on_border(docs, border, "doc_id", "size"), "left")
    none = F.array().cast("array<int>")
    shards = F.sort_array(F.concat(F.coalesce("whole", none), F.coalesce("once", none)))
    return both.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * F.size(shards)).cast("long").alias("taken"), shards.alias("shards"))


def mix(docs: DataFrame, shards: int = 16, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """The mixed rows: ``docs``'s columns, a row per time it is taken, then ``shard, mix_order``.

    Sorted by ``shard, mix_order`` the rows are the mix; ``write_mix`` does so.
    """
    plan = plan_mix(sizes(docs), shards, weights, share, cap)
    size, n, source, doc_id, shard, at = fresh(docs, "mix_size", "mix_pass", "mix_source", "mix_doc", "shard", "mix_order")
    wide = (docs.withColumn(size, size_of(text_of())).withColumn(source, F.col("source").cast("string"))
            .withColumn(doc_id, F.col("doc_id").cast("long")))
    clash = {c: f"kept_{i}" for i, c in enumerate(docs.columns)}
    wide = wide.withColumnsRenamed(clash)
    keep = [clash[c] for c in docs.columns]
    based = _blocks(plan.plan, wide, [*keep, size, doc_id], source, doc_id, size)
    whole = based.join(plan.units, ["sid", "block"]).select(*keep, doc_id, "pass", "shard")
    part = based.join(plan.border, _on_border(based, plan.border, doc_id, size)).select(*keep, doc_id, "pass", "shard")
    rows = whole.unionByName(part)
    return rows.select(*[F.col(clash[c]).alias(c) for c in docs.columns], F.col("shard").alias(shard),
                       F.xxhash64(F.lit(SEED), "pass", "shard", doc_id).alias(at))


def in_mix_order(mixed: DataFrame) -> DataFrame:
    """The rows of ``mix`` shard by shard, each in its local order, without the two
    columns; a shard is cut into 64 ranges of that order, so that several tasks write it."""
    shard, at = mixed.columns[-2:]
    return (mixed.repartition(F.col(shard), F.shiftright(at, 58)).sortWithinPartitions(shard, at)
            .select(*mixed.columns[:-2]))


def write_mix(mixed: DataFrame, path: str, shards: int) -> None:
    """One folder per shard, each shuffled locally by its hash order."""
    (mixed.repartition(shards, "shard").sortWithinPartitions("shard", "mix_order")
     .write.partitionBy("shard").parquet(path))
