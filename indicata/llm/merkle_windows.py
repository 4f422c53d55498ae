"""Operator 12, Merkle dataset manifest: lag and lead windows over the levels of the trees.

DataFrame functions only.

1. Rows become leaves, written once without texts.  A range shuffle by group
   and order, numbers inside its partitions and small tables of counts give
   each leaf its place in its group, so a hot group is spread over tasks.
2. Per level, columns of fixed offsets, ``lag 1 .. 15`` and ``lead 1 .. 15``, masked by a
   node's slot and its run's length, are its siblings.  Windows end at the end
   of a run of runs, so they hold at most ``16 * 16`` nodes.  The rows of first
   children hash the run and are the next level's nodes.
3. From the top down, a node's proof is its siblings and then its parent's
   proof.  The proofs of a block of runs travel in one row to the block's
   windows, so the nodes themselves are dealt out once a level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicata.llm.common import ascii_lower, id_text, stage

FAN = 16
STEP = "array<struct<left:string,right:string>>"


def encoded(c: Column) -> Column:
    """A value for hashing: ``-`` if null, else its bytes' count, a colon and itself."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in columns]), 256)


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``i``, their place in the group from 0, and ``n``, the rows of the group.

    The group is never null.  Ties of ``order`` get places in any order.  Rows are written as the range
    shuffle has dealt them; what follows on them is one join with a row per
    range partition and group.
    """
    keys = [group, *order]
    dealt = rows.repartitionByRange(*[F.col(c).asc_nulls_first() for c in keys]) \
        .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in keys]) \
        .withColumn("__at", F.monotonically_increasing_id())
    dealt = stage(dealt, "numbered")
    part = F.shiftright("__at", 33).alias("__part")
    runs = dealt.groupBy(group, part).agg(F.min("__at").alias("__first"),
                                          F.count(F.lit(1)).alias("__n"))
    own = Window.partitionBy(group)
    before = F.sum("__n").over(own.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(F.col(group).alias("__group"), F.col("__part").alias("__run"),
                       (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"),
                       F.sum("__n").over(own).alias("n"))
    on = (F.col(group) == F.col("__group")) & (part == F.col("__run"))
    return (dealt.join(runs, on).withColumn("i", F.col("__at") + F.col("__shift"))
            .drop("__at", "__group", "__run", "__shift"))


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes (g, i, n, digest) with run, slot, left and right (the siblings' digests, joined)."""
    window = Window.partitionBy("g", "block").orderBy("i")
    slot = F.pmod("i", F.lit(FAN))
    length = F.least(F.lit(FAN), F.col("n") - (F.col("i") - slot))
    nodes = nodes.withColumns({"block": F.floor(F.col("i") / (FAN * FAN)),
                               "run": F.floor(F.col("i") / FAN), "slot": slot, "length": length})
    lags = [F.when(F.col("slot") >= k, F.lag("digest", k).over(window)).otherwise("")
            for k in range(FAN - 1, 0, -1)]
    leads = [F.when(F.col("slot") + k < F.col("length"), F.lead("digest", k).over(window))
             .otherwise("") for k in range(1, FAN)]
    return nodes.withColumns({"left": F.concat(*lags), "right": F.concat(*leads)}).drop("length")


def parents(nodes: DataFrame) -> DataFrame:
    """The next level of the groups that have more than one node left."""
    first = with_siblings(nodes.filter("n > 1")).filter("slot = 0")
    return first.select("g", F.col("run").alias("i"), F.ceil(F.col("n") / FAN).alias("n"),
                        F.sha2(F.concat("digest", "right"), 256).alias("digest"))


def levels(leaves: DataFrame) -> list[DataFrame]:
    """All levels of the trees over ``leaves`` (g, i, n, digest), each written once."""
    found, most = [leaves], leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        found.append(stage(parents(found[-1].select("g", "i", "n", "digest")), "level"))
        most = -(-most // FAN)
    return found


def tops(found: list[DataFrame]) -> DataFrame:
    """The last node of each group."""
    last = [level.filter("n = 1").select("g", "digest") for level in found]
    out = last[0]
    for rows in last[1:]:
        out = out.unionByName(rows)
    return out


def proofs(found: list[DataFrame], above: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The leaves (g, ``keep``, digest) with ``proof``, the left and right siblings by level, and
    ``top``.

    ``above`` has a row per group: g, proof (the steps from its last node on) and top.
    """
    above = above.select(F.col("g").alias("ag"), "proof", "top")
    below = None
    for depth in range(len(found) - 1, -1, -1):
        here = found[depth]
        cols = ["g", "i", *([*keep, "digest"] if depth == 0 else [])]
        # a group's last node, on the level where it is alone
        alone = here.filter("n = 1").join(above, F.col("g") == F.col("ag")) \
            .select(*cols, "proof", "top")
        if below is None:
            below = alone
            continue
        # one row a block: the proofs of its runs by slot, met by the block's windows
        up = below.select(F.col("g").alias("pg"), F.floor(F.col("i") / FAN).alias("pb"),
                          F.struct(F.pmod("i", F.lit(FAN)).alias("slot"), "proof", "top").alias("p"))
        up = up.groupBy("pg", "pb").agg(F.sort_array(F.collect_list("p")).alias("up"))
        own = F.array(F.struct("left", "right"))
        mine = F.col("up")[F.pmod("run", F.lit(FAN)).cast("int")]
        met = with_siblings(here.filter("n > 1")) \
            .join(up, (F.col("g") == F.col("pg")) & (F.col("block") == F.col("pb")))
        below = met.select(*cols, F.concat(own, mine["proof"]).alias("proof"),
                           mine["top"].alias("top")).unionByName(alone)
    return below


def fold(digest: Column, proof: Column) -> Column:
    """The root that follows from a leaf and its proof."""
    return F.aggregate(proof, digest,
                       lambda a, s: F.sha2(F.concat(s["left"], a, s["right"]), 256))


def tampered_text(text: Column, id_col: Column) -> Column:
    """A-Z in lower case where 5 divides the crc32 of the id; a null id has no crc."""
    return F.when(F.coalesce(F.crc32(id_text(id_col)) % 5 == 0, F.lit(False))
                  & id_col.isNotNull(), ascii_lower(text)).otherwise(text)


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source",
             text_col: str = "text", tampered: Column | None = None,
             columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """Per row: its leaf, subroot, root, proof and a check of a copy of the text against them.

    Columns: the id, group, leaf, subroot, root, proof (array of left and right
    siblings by level), proof_sha256, folded_root, verified.  ``tampered`` is the
    text under check, ``tampered_text`` if none is given.  A null id comes first in
    its group, a null group is a group of its own and comes first.  Rows that
    repeat an id are leaves of their own, ordered by their hashes.  A single
    row has no siblings: its leaf is the root.  An empty table gives an empty
    result.
    """
    text = F.col(text_col)
    other = tampered_text(text, F.col(id_col)) if tampered is None else tampered
    leaf = leaf_hash([F.col(c) for c in columns])
    changed = leaf_hash([other if c == text_col else F.col(c) for c in columns])
    # never null, so that joins on it keep the windows' partitioning; null sorts first
    group = F.coalesce(F.concat(F.lit("s"), F.col(group_col).cast("string")), F.lit("n"))
    rows = docs.select(F.col(id_col).alias("id"), group.alias("g"), leaf.alias("digest"),
                       F.when(~other.eqNullSafe(text), changed).alias("changed"))
    trees = levels(stage(numbered(stage(rows, "leaves"), "g", ["id", "digest"]), "places"))
    over = tops(trees).select(F.lit(0).alias("g"), F.col("g").alias("name"), "digest")
    over = levels(stage(numbered(over, "g", ["name"]), "subroots"))
    last = tops(over).first()
    root = F.lit(last["digest"] if last else None).cast("string")
    none = docs.sparkSession.createDataFrame([(0, [], last["digest"] if last else None)],
                                             f"g int, proof {STEP}, top string")
    above = stage(proofs(over, none, ["name"]).select(F.col("name").alias("g"), "proof",
                                                      F.col("digest").alias("top")), "above")
    found = proofs(trees, above, ["id", "changed"])
    joined = F.aggregate("proof", F.lit(""),
                         lambda a, s: F.concat(a, s["left"], s["right"]))
    return found.select(
        F.col("id").alias(id_col),
        F.when(F.col("g") != "n", F.substring("g", 2, 1 << 30)).alias(group_col),
        F.col("digest").alias("leaf"), F.col("top").alias("subroot"), root.alias("root"), "proof",
        F.sha2(joined, 256).alias("proof_sha256"),
        fold(F.coalesce("changed", "digest"), F.col("proof")).alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))
