"""Mix sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Sources get targets in words. A document of a source whose target is r times its size is taken
floor(r) times and once more with probability r - floor(r). These last copies are not drawn one by
one: two documents with open copies exchange words (the mass of a copy is its probability times
the document's words) until one copy is whole or gone, in a random direction that leaves both
probabilities as they were on average. So every document has its probability, and the words of a
source stay at the target up to the one copy that is left over at the end.

The exchange runs down blocks of 128 documents of a source, each block leaves one open copy, and
the open copies of the blocks form the next, 128 times smaller level of the reduction tree.

* Null text has size 0. A document of size 0 is taken with 0 words, whatever its copies are.
* Null source is a source of its own and the last one; a null id comes first in its source.
* Equal rows are one document each; which of them is taken more often is not fixed, the set of
  results is. Draws depend on ids of places (source, rank by id and size) alone, so reruns agree.
* A source without words has target 0. An empty table gives no rows.
* Only id, text and source are read; other columns, whatever their names, take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylake.llm.common import written
from quarrylake.llm.ordered import ranked

WORD = r"[^\x20\x09-\x0D]+"
#: Open copies that meet one after another in a task.
BLOCK = 128


def sizes(docs: DataFrame, id_field: str = "doc_id", text_field: str = "text", source_field: str = "source") -> DataFrame:
    """(key, id, size): words of each text. Keys sort as sources do, code point by code point, null last."""
    source = F.col(source_field).cast("string")
    return docs.select(
        F.coalesce(F.concat(F.lit("+"), source), F.lit("-")).alias("key"),
        F.col(id_field).alias("id"),
        F.coalesce(F.regexp_count(F.col(text_field).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )


def targets(sized: DataFrame, share: float, limit: float, weights: tuple[float, ...]) -> DataFrame:
    """(key, source_size, target): words of each source in the mix.

    The sources, in order of their keys, weigh ``weights`` in turn and share ``share`` times all
    words. Targets stop at ``limit`` times the source; what is above goes to the others by weight.
    Each round fixes the sources that are above, so there are at most as many rounds as sources;
    two sums per round come to the driver.
    """
    sources = sized.groupBy("key").agg(F.sum("size").alias("source_size")).withColumn("mix", F.lit(0))
    sources = ranked(sources, "mix", ["key"], "mixture-ranked")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = written(
        sources.select("key", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(float(limit))).alias("cap")),
        "mixture-sources",
    )
    whole, open_weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    whole = float(share) * (whole or 0)
    left, fixed = whole, F.lit(False)
    while open_weight:
        above = F.col("weight") * F.lit(left) / F.lit(open_weight) >= F.col("cap")
        taken, still_open = sources.agg(F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("weight")))).first()
        fixed, done = above, (still_open or 0.0) == open_weight
        level = F.col("weight") * F.lit(left) / F.lit(open_weight)
        left, open_weight = whole - (taken or 0.0), still_open or 0.0
        if done:
            break
    target = F.when(fixed, F.col("cap")).otherwise(level) if whole else F.lit(0.0)
    return sources.select("key", "source_size", target.alias("target"))


def _draw(seed: int, key: Column, one: Column, other: Column) -> Column:
    """A number in [0, 1) that depends on the pair of places alone."""
    text = F.concat_ws("|", F.lit(str(seed)), key, one.cast("string"), other.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _meet(seed: int, key: Column, held: Column, unit: Column) -> Column:
    """Two open copies after the exchange: (held: still open, decided: whole or gone)."""

    def exchanged(v: Column) -> Column:
        gains, loses = v["gain"], v["loss"]
        up = v["draw"] * (gains + loses) < loses
        filled = up & (gains == held["size"] - held["mass"])
        emptied = ~up & (loses == held["mass"])
        held_mass = F.when(filled, held["size"].cast("double")).when(emptied, 0.0)
        held_mass = held_mass.when(up, held["mass"] + gains).otherwise(held["mass"] - loses)
        unit_mass = F.when(up & (gains == unit["mass"]), 0.0).when(up, unit["mass"] - gains)
        unit_mass = unit_mass.when(loses == unit["size"] - unit["mass"], unit["size"].cast("double")).otherwise(unit["mass"] + loses)
        return F.struct(_with_mass(held, held_mass).alias("one"), _with_mass(unit, unit_mass).alias("other"), (filled | emptied).alias("settled"))

    def parted(pair: Column) -> Column:
        return F.struct(
            F.when(pair["settled"], pair["other"]).otherwise(pair["one"]).alias("held"),
            F.when(pair["settled"], pair["one"]).otherwise(pair["other"]).alias("decided"),
        )

    both = F.struct(
        F.least(held["size"] - held["mass"], unit["mass"]).alias("gain"),
        F.least(held["mass"], unit["size"] - unit["mass"]).alias("loss"),
        _draw(seed, key, held["rank"], unit["rank"]).alias("draw"),
    )
    return _let(_let(both, exchanged), parted)


def _with_mass(unit: Column, mass: Column) -> Column:
    return F.struct(unit["rank"].alias("rank"), unit["id"].alias("id"), unit["size"].alias("size"), mass.alias("mass"))


def _level(units: DataFrame, seed: int) -> DataFrame:
    """Each block of open copies after its exchanges: the decided copies and the one that is held."""
    blocks = units.groupBy("key", F.floor(F.col("place") / BLOCK).cast("long").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("place", "unit"))).alias("entries"),
        F.ceil(F.first("members") / BLOCK).cast("long").alias("members"),
    )
    first = F.element_at("entries", 1)["unit"]
    none = F.slice(F.transform("entries", lambda e: e["unit"]), 1, 0)

    def step(state: Column, entry: Column) -> Column:
        return _let(
            _meet(seed, F.col("key"), state["held"], entry["unit"]),
            lambda met: F.struct(
                met["held"].alias("held"), F.array_append(state["decided"], met["decided"]).alias("decided")
            ),
        )

    start = F.struct(first.alias("held"), none.alias("decided"))
    run = F.aggregate(F.slice("entries", F.lit(2), F.size("entries")), start, step)
    return blocks.select("key", F.col("block").alias("place"), "members", run.alias("run")).select(
        "key", "place", "members", "run.held", "run.decided"
    )


def rounded(units: DataFrame, seed: int) -> DataFrame:
    """(key, id, size, mass, whole) of units (key, rank, members, id, size, mass), mass from 0 to size."""
    unit = F.struct("rank", "id", "size", "mass")
    level, decided = units.select("key", F.col("rank").alias("place"), "members", unit.alias("unit")), []
    while True:
        done = written(_level(level, seed), "mixture-level")
        held = F.col("held")
        last = _draw(seed, F.col("key"), held["rank"], held["rank"]) * held["size"] < held["mass"]
        left_over = _with_mass(held, F.when(last, held["size"].cast("double")).otherwise(0.0))
        decided.append(done.select("key", F.explode("decided").alias("unit")))
        decided.append(done.where("members = 1").select("key", left_over.alias("unit")))
        level = done.where("members > 1").select("key", "place", "members", held.alias("unit"))
        if level.isEmpty():
            break
    rows = decided[0]
    for more in decided[1:]:
        rows = rows.unionByName(more)
    whole = (F.col("unit.size") > 0) & (F.col("unit.mass") >= F.col("unit.size"))
    return rows.select("key", "unit.id", "unit.size", whole.cast("long").alias("whole"))


def mix(
    docs: DataFrame,
    share: float = 1.5,
    limit: float = 2.0,
    weights: tuple[float, ...] = (5, 2, 1),
    seed: int = 1,
    id_field: str = "doc_id",
    text_field: str = "text",
    source_field: str = "source",
) -> DataFrame:
    """Each document with its size, its source's size and target, its copies in the mix and the words taken."""
    sized = written(sizes(docs, id_field, text_field, source_field), "mixture-sizes")
    wanted = targets(sized, share, limit, weights)
    placed = ranked(sized, "key", ["id", "size"], "mixture-placed")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = placed.join(wanted, "key").select(
        "key", "rank", "members", "id", "size", ((rate - F.floor(rate)) * F.col("size")).alias("mass")
    )
    copies = F.floor(rate).cast("long") + F.col("whole")
    return rounded(units, seed).join(wanted, "key").select(
        F.col("id").alias(id_field),
        F.when(F.col("key") != "-", F.substring("key", 2, 2**31 - 1)).alias(source_field),
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )
