"""Links between texts that share a band of their sketches, and the components of the links.

Members of a bucket (texts with one band value) are not paired with each other. First
every member meets the bucket's hub. Where that leaves members unlinked, the bucket is cut into blocks of
bounded size, and each task compares two blocks: pairs that are not linked yet, that
share no earlier band, and whose distances to the hub differ by no more than the
allowed distance (1 - Jaccard similarity is a metric). The members of the bucket's largest component
have blocks of their own, which meet only those of the others. So rows grow with the number of
blocks of the others, only links come out. Every pair is verified on the texts, so the
components are those of all similar pairs that share a band.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylake.llm.common import arrow_map, connected, written


#: Members of a block, about.
BLOCK = 256


def verified(pairs: DataFrame, texts: DataFrame, feature: Callable, similarity: Callable) -> DataFrame:
    """(a, b, similarity) of pairs of contents, by ``similarity(feature(text), feature(text))``."""
    kind = texts.schema["content"].dataType.simpleString()
    left = texts.select(F.col("content").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("content").alias("b"), F.col("text").alias("text_b"))

    def run(batches):
        last, own = None, None
        for batch in batches:
            out = []
            for a, text_a, text_b in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if own is None or a != last:
                    last, own = a, feature(text_a.as_py())
                out.append(similarity(own, feature(text_b.as_py())))
            yield {"a": batch.column(0), "b": batch.column(1), "similarity": out}

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return arrow_map(both, run, f"a {kind}, b {kind}, similarity double")


def components(
    contents: DataFrame,
    texts_of: Callable[[DataFrame], DataFrame],
    feature: Callable,
    similarity: Callable,
    threshold: float,
    purpose: str,
    similarities: Callable | None = None,
) -> DataFrame:
    """(content, root) of ``contents`` (content, bands array<long>), one row per content: root is the least content linked to it.

    ``texts_of(wanted)`` gives (content, text) for the contents of ``wanted``. Contents
    without a link are left out; a content without bands has none. ``similarities(features, features)`` gives the
    matrix of ``similarity``, if all pairs of two blocks cost less than one by one.
    """
    keyed = contents.select("content", F.explode(F.array_distinct("bands")).alias("band"))
    # dealt once: the members and the hubs read the same shuffle
    keyed = keyed.where("band IS NOT NULL AND content IS NOT NULL").repartition("band")
    hubs = keyed.groupBy("band").agg(F.min("content").alias("hub"), F.max("content").alias("last")).where("hub <> last")
    members = written(
        keyed.join(hubs.select("band", "hub"), "band").where("content <> hub").select("band", "hub", "content"),
        f"{purpose}-members",
    )
    wanted = members.select("content").union(members.select("hub")).distinct()
    texts = written(texts_of(wanted), f"{purpose}-texts")
    pairs = members.select(F.col("hub").alias("a"), F.col("content").alias("b")).distinct()
    seen = written(verified(pairs, texts, feature, similarity), f"{purpose}-similarities")
    links = seen.where(F.col("similarity") >= threshold).select("a", "b")
    roots = connected(links, f"{purpose}-components")

    more = written(_open_links(members, contents, texts, seen, roots, feature, similarity, threshold, similarities), f"{purpose}-links")
    if not more.isEmpty():
        roots = connected(links.unionByName(more), f"{purpose}-components")
    return roots.select(F.col("node").alias("content"), "root")


def _open_links(
    members: DataFrame,
    contents: DataFrame,
    texts: DataFrame,
    seen: DataFrame,
    roots: DataFrame,
    feature: Callable,
    similarity: Callable,
    threshold: float,
    similarities: Callable | None = None,
) -> DataFrame:
    """Links (a, b) between members of a bucket that the hub has left in different components."""
    placed = (
        members.join(seen.select(F.col("a").alias("hub"), F.col("b").alias("content"), "similarity"), ["hub", "content"])
        .join(roots.select(F.col("node").alias("content"), "root"), "content", "left")
        .withColumn("root", F.coalesce("root", "content"))
        .select("band", "content", "root", "similarity")
    )
    # members of a bucket's largest component are not compared with each other: their blocks meet the blocks of the others only
    sizes = placed.groupBy("band", "root").agg(F.count("*").alias("n"))
    still_open = (
        sizes.groupBy("band")
        .agg(F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("largest"))
        .where(F.col("largest.n") < F.col("n"))
        .select(
            "band",
            F.col("largest.root").alias("main"),
            F.ceil((F.col("n") - F.col("largest.n")) / BLOCK).cast("int").alias("blocks"),
            F.ceil(F.col("largest.n") / BLOCK).cast("int").alias("main_blocks"),
        )
    )
    hashed, in_main = F.xxhash64("content"), F.col("root") == F.col("main")
    block = F.when(in_main, F.col("blocks") + F.pmod(hashed, F.col("main_blocks"))).otherwise(F.pmod(hashed, F.col("blocks")))
    row = placed.join(still_open, "band").withColumn("block", block.cast("int"))
    last = F.when(in_main, F.col("blocks")).otherwise(F.col("blocks") + F.col("main_blocks")) - 1
    dealt = (
        row.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
        .withColumns({"p": F.least("block", "other"), "q": F.greatest("block", "other")})
        .select("band", "p", "q", "block", "content", "root", "similarity")
        .join(contents.select("content", "bands"), "content")
        .join(texts.select("content", "text"), "content")
    )
    allowed = 1 - threshold + 1e-9

    kind = texts.schema["content"].dataType.simpleString()

    def compare(rows: pa.Table) -> pa.Table:
        first, second, band = (rows.column(c)[0].as_py() for c in ("p", "q", "band"))
        blocks, similar = rows.column("block").to_numpy(), rows.column("similarity").to_numpy()
        left = np.flatnonzero(blocks == first)
        right = left if first == second else np.flatnonzero(blocks == second)
        near = np.abs(similar[left][:, None] - similar[right]) <= allowed
        numbers: dict = {}
        at = np.array([numbers.setdefault(root, len(numbers)) for root in rows.column("root").to_pylist()])
        near &= at[left][:, None] != at[right]
        if first == second:
            near &= np.triu(np.ones_like(near), 1)
        if near.any():
            bands = np.stack(rows.column("bands").to_numpy())
            done = np.zeros_like(near)
            for k in range(bands.shape[1]):  # a pair counts in its first common band
                same = bands[left, k][:, None] == bands[right, k]
                near &= ~(done & (bands[left, k] == band)[:, None] & same)
                done |= same
        known: dict[int, int] = {}

        def top(x: int) -> int:
            while known.get(x, x) != x:
                x = known[x]
            return x

        cache: dict = {}

        def feature_of(row: int):
            if row not in cache:
                cache[row] = feature(rows.column("text")[row].as_py())
            return cache[row]

        found = []
        if similarities and near.sum() > BLOCK:
            i, j = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
            sides = [[feature_of(row) for row in side.tolist()] for side in (left[i], right[j])]
            near[np.ix_(i, j)] &= similarities(*sides) >= threshold - 1e-9
        for i, j in np.argwhere(near).tolist():
            a, b = int(left[i]), int(right[j])
            x, y = top(at[a]), top(at[b])
            if x != y and similarity(feature_of(a), feature_of(b)) >= threshold:
                known[x] = y
                found.append((a, b))
        contents = rows.column("content")
        return pa.table({c: contents.take(pa.array([pair[k] for pair in found], pa.int64())) for k, c in enumerate("ab")})

    return dealt.groupBy("band", "p", "q").applyInArrow(compare, f"a {kind}, b {kind}")
