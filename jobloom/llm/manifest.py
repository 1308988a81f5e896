"""Merkle manifest of a dataset, and proofs climbed by a recursive query.

Every row is a leaf; the leaves of a group (``lang``) make a binary tree by id, the groups' roots make another one.
Levels are built bottom up, six and then always twelve at a time: at most 64 leaves or 4,096 nodes with one ancestor
meet.  What is stored is a row per node of the levels 0, 6, 18, 30, ... with a link to the ancestor on the next of them
and the siblings on the way there; a leaf's own row is the lowest.  A recursive query of Spark then climbs from every
leaf at once, appends the siblings and folds the leaf's digest into them, until a node has no parent.  Few long rows
make few rounds, and each round shuffles all proofs.

Near the root all leaves climb through the same nodes, so a node is stored once per 4,096 leaves below it and the leaves
share its copies out among them; no join key is hot.  Places in a group come from sampled ranges and their counts, so a
group may hold any share of the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.llm.common import setting, written

#: Leaves that share a copy of a node.
SHARE = 4096
_TOP = -1  # the tree over the groups' roots
#: ``passed`` holds the siblings' digests bottom up, ``turns`` a sign per level: l and r for a left or right sibling.
_LINK = "passed binary, turns string, top binary, up_tree long, up_stage int, up_idx long, up_leaves long"
_NODE = f"tree long, stage int, idx long, leaves long, digest binary, {_LINK}"


def field_text(value: Column) -> Column:
    """``-`` for null, else byte count, colon and value, so that no two rows share a concatenation."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 of the fields' texts in a row."""
    return F.unhex(F.sha2(F.concat(*map(field_text, fields)).cast("binary"), 256))


def placed(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` with ``idx``, the place from 0 in its group by ``order`` (nulls first), and ``size`` of the group.

    Rows are cut into sampled ranges over group and order; only row counts per range and group meet.  Rows equal in
    both are dealt over ranges too, by a running number, and take any of their places.
    """
    parts = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    numbered = written(rows.withColumn("_n", F.monotonically_increasing_id()), "manifest-rows")
    dealt = numbered.repartitionByRange(parts, *group, *order, "_n")
    ranged = written(dealt.withColumn("_range", F.spark_partition_id()), "manifest-ranges")
    counts = ranged.groupBy("_range", *group).agg(F.count("*").alias("_rows"))
    whole = Window.partitionBy(*group)
    counts = counts.select(
        F.col("_range").alias("_c_range"),
        *(F.col(c).alias(f"_c_{c}") for c in group),
        (F.sum("_rows").over(whole.orderBy("_range")) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(whole).alias("size"),
    )
    inside = F.row_number().over(Window.partitionBy("_range", *group).orderBy(*order, "_n"))
    same = F.col("_range") == F.col("_c_range")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_c_{c}"))
    found = ranged.withColumn("_inside", inside).join(counts, same)
    return found.withColumn("idx", F.col("_before") + F.col("_inside") - 1).select(*rows.columns, "idx", "size")


def levels(size: int) -> int:
    """Levels above the leaves of a tree with so many."""
    return max(0, (size - 1).bit_length())


def stored_level(stage: int) -> int:
    """The level of the stored nodes number ``stage``, from below."""
    return max(0, 12 * stage - 6)


def climb_group(members: list[tuple[int, bytes]], rise: int) -> tuple[bytes, list[tuple[bytes, str]]]:
    """Digest of the ancestor ``rise`` levels up, and per member (place, digest) its ``passed`` and ``turns``."""
    passed, turns = [b""] * len(members), [""] * len(members)
    now = [(place, digest, [i]) for i, (place, digest) in enumerate(members)]
    for _ in range(rise):
        runs = {}
        for node in now:
            runs.setdefault(node[0] // 2, []).append(node)
        now = []
        for place, run in runs.items():
            for j, (_, _, below) in enumerate(run):
                for i in below:
                    passed[i] += b"".join(d for k, (_, d, _) in enumerate(run) if k != j)
                    turns[i] += "-" if len(run) == 1 else "l" if j else "r"
            digest = hashlib.sha256("".join(d.hex() for _, d, _ in run).encode()).digest()
            now.append((place, digest, [i for _, _, below in run for i in below]))
    return now[0][1], list(zip(passed, turns, strict=True))


def _built(top: bool, columns: Sequence[str]):
    """Groups of up to 64 nodes to their rows, each linked to the common ancestor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 64) for b in batches for i in range(0, b.num_rows, 64)):
            out = {c: [] for c in columns}
            for group in batch.to_pylist():
                members = sorted(group["members"], key=lambda m: m["idx"])
                here, following = stored_level(group["stage"]), stored_level(group["stage"] + 1)
                height = levels(group["size"])
                digest, ways = climb_group([(m["idx"], m["digest"]) for m in members], min(following, height) - here)
                up = (group["tree"], group["stage"] + 1, group["up"])
                if height <= following:
                    up = (None, None, None) if top else (_TOP, 0, group["tree"])
                common = {
                    **{c: group[c] for c in ("tree", "stage", "size")},
                    **dict(zip(("up_tree", "up_stage", "up_idx"), up, strict=True)),
                    "top": digest if height <= following else None,
                    "up_digest": digest,
                    "up_leaves": sum(m["leaves"] for m in members),
                }
                for m, (passed, turns) in zip(members, ways, strict=True):
                    row = {**common, **m, "passed": passed, "turns": turns}
                    for c in columns:
                        out[c].append(row[c])
            # Spark's Arrow reader takes plain lists of these types as they are; all-null columns need one.
            yield pa.RecordBatch.from_arrays([pa.array(out[c], _ARROW.get(c)) for c in columns], names=list(columns))

    return run


_ARROW = {"stage": pa.int32(), "turns": pa.string(), **dict.fromkeys(("digest", "passed", "top", "up_digest", "given"), pa.binary()),
          **dict.fromkeys(("tree", "idx", "leaves", "up_tree", "up_idx", "up_leaves", "size", "id"), pa.int64()), "up_stage": pa.int32()}


def build_levels(leaves: DataFrame, top: bool = False, carry: str = "") -> tuple[DataFrame, DataFrame | None]:
    """Parent-linked node rows of trees given by their leaves (``tree``, ``idx``, ``size``, ``digest``, ``leaves``).

    The leaves' rows come first, with the columns ``carry`` (name and type) besides; the rows of higher levels second,
    none if no tree has more than 64 leaves.  ``top`` is the root's digest in rows whose parent is the root.  The root
    of a group's tree is leaf ``tree`` of the top tree.
    """
    more = [part.split()[0] for part in carry.split(", ")] if carry else []
    below, stage, low, high = leaves.withColumn("stage", F.lit(0)), 0, None, None
    while True:
        group = ["tree", "stage", "size", F.shiftright("idx", stored_level(stage + 1) - stored_level(stage)).alias("up")]
        met = below.groupBy(*group).agg(F.collect_list(F.struct("idx", "digest", "leaves", *more)).alias("members"))
        schema = f"{_NODE}, size long, up_digest binary" + (f", {carry}" if more else "")
        columns = [part.split()[0] for part in schema.split(", ")]
        nodes = written(met.mapInArrow(_built(top, columns), schema), "manifest-nodes")
        if low is None:
            low = nodes
        else:
            high = nodes if high is None else high.union(nodes)
        rest = nodes.where("top is null")
        if not rest.head(1):
            return low, high
        below = rest.groupBy("tree", F.col("up_stage").alias("stage"), "size", F.col("up_idx").alias("idx")).agg(
            F.first("up_digest").alias("digest"), F.first("up_leaves").alias("leaves")
        )
        carry, more, stage = "", [], stage + 1


def build_manifest(leaves: DataFrame, group: str, carry: str) -> tuple[DataFrame, DataFrame]:
    """Node rows of a dataset: those of its leaves with the columns ``carry``, and those above them.

    ``leaves`` are rows with ``group``, ``idx``, ``size``, ``digest`` and the carried columns.  A group's ``tree`` is
    its number among all, null first, then by bytes.
    """
    groups = leaves.groupBy(F.col(group).alias("_group")).agg(F.count("*").alias("_rows")).withColumn("_one", F.lit(0))
    numbered = placed(groups, ["_one"], ["_group"])
    numbered = written(numbered.select("_group", F.col("idx").alias("tree"), F.col("size").alias("groups")), "manifest-groups")
    ranked = leaves.join(numbered, F.col(group).eqNullSafe(F.col("_group"))).withColumn("leaves", F.lit(1).cast("long"))
    names = [*(part.split()[0] for part in _NODE.split(", ")), "subroot", "root"]
    low, high = build_levels(ranked, carry=carry)
    ends = low if high is None else low.select(*high.columns).union(high)
    roots = ends.where("up_tree = -1").groupBy("tree").agg(F.first("top").alias("digest"), F.first("up_leaves").alias("leaves"))
    upper = roots.join(numbered, "tree").select(
        F.lit(_TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.col("groups").alias("size"), "digest", "leaves"
    )
    first, higher = build_levels(upper, top=True)
    nodes = [_through_top(high, first).select(*names)] if high is not None else []
    nodes.append((first.where("false") if higher is None else higher).withColumns({"subroot": F.lit(None).cast("binary"), "root": F.col("top")}).select(*names))
    return _through_top(low, first), reduce(DataFrame.union, nodes)


def _through_top(nodes: DataFrame, first: DataFrame) -> DataFrame:
    """Links that end in a group's root go on through the top tree's lowest stored step, which saves a round."""
    link = [c.split()[0] for c in _LINK.split(", ")]
    inner = nodes.where("top is null").withColumns({"subroot": F.lit(None).cast("binary"), "root": F.lit(None).cast("binary")})
    above = first.select(F.col("idx").alias("_tree"), *(F.col(c).alias(f"_{c}") for c in link))
    met = nodes.where("top is not null").join(above, F.col("tree") == F.col("_tree"))
    ended = met.withColumns({"subroot": F.col("top"), "root": F.col("_top")}).withColumns(
        {
            **{c: F.concat(c, f"_{c}") for c in ("passed", "turns")},
            **{c: F.col(f"_{c}") for c in link if c.startswith("up_")},
        }
    )
    return inner.unionByName(ended.select(*inner.columns))


_STEP = """aggregate(regexp_extract_all({turns}, '(.)'), named_struct('h', lower(hex({folded})), 'rest', lower(hex({passed}))),
  (a, t) -> named_struct(
    'h', sha2(CASE t WHEN 'l' THEN concat(left(a.rest, 64), a.h) WHEN 'r' THEN concat(a.h, left(a.rest, 64)) ELSE a.h END, 256),
    'rest', IF(t = '-', a.rest, substring(a.rest, 65))), a -> unhex(a.h))"""

_CLIMB = f"""
WITH RECURSIVE climb (id, leaf, spread, tree, stage, idx, copy, folded, passed, subroot, root) AS (
  SELECT id, digest, spread, up_tree, up_stage, up_idx, pmod(spread, up_copies),
    {_STEP.format(turns="turns", folded="given", passed="passed")}, passed, subroot, root
  FROM {{leaves}}
  UNION ALL
  SELECT c.id, c.leaf, c.spread, n.up_tree, n.up_stage, n.up_idx, pmod(c.spread, n.up_copies),
    {_STEP.format(turns="n.turns", folded="c.folded", passed="n.passed")}, concat(c.passed, n.passed),
    coalesce(c.subroot, n.subroot), n.root
  FROM climb c JOIN {{nodes}} n ON n.tree = c.tree AND n.stage = c.stage AND n.idx = c.idx AND n.copy = c.copy WHERE c.tree IS NOT NULL)
SELECT id, leaf, folded, unhex(sha2(lower(hex(passed)), 256)) AS proof, subroot, root FROM climb WHERE tree IS NULL
"""


def prove(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """(``id``, ``leaf``, ``folded``, ``proof``, ``subroot``, ``root``) per leaf row.

    ``folded`` is the root recomputed from ``given`` and the stored siblings, ``proof`` the digest of the siblings bottom
    up, ``subroot`` and ``root`` what is stored.
    """
    spark = leaves.sparkSession
    copies = lambda n: F.expr(f"({n} + {SHARE - 1}) div {SHARE}")
    dealt = nodes.withColumns({"copy": F.explode(F.sequence(F.lit(0).cast("long"), copies("leaves") - 1)), "up_copies": copies("up_leaves")})
    spread = leaves.withColumns({"spread": F.xxhash64("tree", "idx"), "up_copies": copies("up_leaves")})
    with setting(spark, "spark.sql.cteRecursionRowLimit", "-1"):
        return written(spark.sql(_CLIMB, leaves=spread, nodes=dealt), "manifest-proofs")


def merkle_manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    *,
    id_col: str = "doc_id",
    group_col: str = "lang",
    tampered: dict[str, Column] | None = None,
) -> DataFrame:
    """(``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``) per row.

    A leaf is the digest of ``fields``; ``tampered`` replaces some of them before the check, and ``verified`` says
    whether the root folded from the leaf so changed is the stored one.  Null groups are a group, null ids come first;
    rows with equal ids are ordered by leaf, and equal rows take any of their places, which have different proofs.
    A lone leaf is its group's root, a lone group's root the root, with the digest of nothing as proof.  An empty table
    gives an empty result; further columns are left unread.
    """
    own = {c: F.col(f"`{c}`") for c in fields}
    claims = {**own, **(tampered or {})}
    same = reduce(Column.__and__, (claims[c].eqNullSafe(own[c]) for c in fields))
    given = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{group_col}`").alias("grp"),
        leaf_digest(*own.values()).alias("digest"),
        F.when(~same, leaf_digest(*(claims[c] for c in fields))).alias("given"),
    )
    # A finished job's shuffle files go at once, not when the driver next collects garbage.
    with setting(docs.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        spots = written(placed(given, ["grp"], ["id", "digest"]), "manifest-leaves")
        low, above = build_manifest(spots, "grp", "id long, given binary")
        proofs = prove(low.withColumn("given", F.coalesce("given", "digest")), above)
    text = lambda c: F.lower(F.hex(c))
    return proofs.select(
        F.col("id").alias("doc_id"),
        text("leaf").alias("leaf"),
        text("subroot").alias("subroot"),
        text("root").alias("root"),
        text("proof").alias("proof_sha256"),
        text("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
