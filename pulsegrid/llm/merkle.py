"""A Merkle manifest of a table: a root per group, a root over all, and a proof for every row.

Rows are numbered inside their group without putting a group into one task, and cells of fanout^2
consecutive leaves are hashed each in one row. Above the cells, subtree roots are swapped in a
butterfly: in round r a cell exchanges its subtree's root with the cells of the same place in the
other subtrees of its aligned group of `fanout`, and every one of them hashes the common ancestor for
itself. After the last round each cell holds the group's root and all upper siblings; nothing is
sent back down.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators.joins import attach
from pulsegrid.operators.ordering import running_counts
from pulsegrid.session import materialise

FANOUT = 16
#: Levels that are hashed inside a cell.
CELL_LEVELS = 2
#: Rows of a slice in which rows are numbered: at least, and slices at most.
SLICE_ROWS, SLICES = 1 << 14, 2_000

LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"


def digest(*texts: Column | str) -> Column:
    return F.sha2(F.concat(*texts), 256)


def leaf_digest(**columns: Column) -> Column:
    """Digest of values in order, each '-' if null, else its UTF-8 length, ':' and itself."""
    parts = []
    for column in columns.values():
        text = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(*parts)


def _joined(hashes: Column) -> Column:
    return F.array_join(hashes, "")


def _siblings(nodes: Column, place: Column, fanout: int) -> Column:
    """The nodes before and after a place in its run of `fanout`, joined."""
    first = place - place % fanout
    return F.struct(
        _joined(F.slice(nodes, first + 1, place % fanout)).alias("before"),
        _joined(F.slice(nodes, place + 2, F.lit(fanout - 1) - place % fanout)).alias("after"),
    )


def _parents(nodes: Column, fanout: int) -> Column:
    starts = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / fanout).cast("int"))
    return F.transform(starts, lambda i: digest(_joined(F.slice(nodes, i * fanout + 1, fanout))))


def manifest(leaves: DataFrame, order: list[str], fanout: int = FANOUT) -> DataFrame:
    """`leaves` (group, never null; leaf; the columns of `order`; others) with `root` and `path`.

    Leaves of a group ascend by `order`, nulls first, equal ones by leaf. `path` lists, level by
    level, the siblings of a leaf's ancestors in front of and behind them, joined. A lone leaf is its group's
    root, with an empty path. No leaves, no rows.
    """
    own = leaves.columns
    rows = materialise(leaves.withColumn("_row", F.monotonically_increasing_id()), "leaves")
    slice_rows = max(SLICE_ROWS, rows.count() // SLICES)
    numbered = running_counts(rows, ["group"], [*order, "leaf", "_row"], {"_n": F.lit(True)}, slice_rows)
    place = F.col("_n") - 1
    size = fanout**CELL_LEVELS
    numbered = numbered.withColumn("_cell", F.floor(place / size)).withColumn("_at", (place % size).cast("int"))
    rest = [c for c in own if c != "group"]
    cells = numbered.groupBy("group", "_cell").agg(
        F.sort_array(F.collect_list(F.struct("_at", *rest))).alias("_leaves")
    )
    cells = materialise(cells, "cells")
    totals = cells.groupBy("group").agg(
        F.sum(F.size("_leaves")).alias("_total"), F.count("*").alias("_cells")
    )
    cells = attach(cells, totals, ["group"], spread_by=["_cell"])

    # inside a cell: levels are built as long as the group has several nodes there
    nodes = [F.transform("_leaves", lambda x: x["leaf"])]
    for level in range(CELL_LEVELS):
        cells = cells.withColumn(f"_nodes{level}", nodes[-1])
        below = F.col(f"_nodes{level}")
        nodes.append(F.when(F.col("_total") > fanout**level, _parents(below, fanout)).otherwise(below))
    cells = cells.withColumn("_root", F.get(nodes[-1], F.lit(0)))

    upper = _butterfly(cells.select("group", "_cell", "_cells", "_root"), fanout)
    found = cells.drop("_root", "_cells").join(upper, ["group", "_cell"])

    def path(at: Column) -> Column:
        steps = [
            F.when(
                F.col("_total") > fanout**level,
                _siblings(F.col(f"_nodes{level}"), F.floor(at / fanout**level).cast("int"), fanout),
            )
            for level in range(CELL_LEVELS)
        ]
        return F.concat(F.array_compact(F.array(*steps)), F.col("_path"))

    out = found.select("group", "_root", "_path", "_total", *[f"_nodes{k}" for k in range(CELL_LEVELS)], F.inline("_leaves"))
    return out.select(*own, F.col("_root").alias("root"), path(F.col("_at")).alias("path"))


def _butterfly(cells: DataFrame, fanout: int) -> DataFrame:
    """`group`, `_cell`, the group's `_root` and the siblings above the cell as `_path`.

    `cells` has a root for each cell and the group's number of cells. In a group's last, shorter subtree
    cells are fewer than in its neighbours: each also serves the places that it lacks.
    """
    nodes = cells.withColumn("_path", F.array().cast(PATH))
    most = cells.agg(F.max("_cells")).first()[0] or 0
    width = 1
    while width < most:
        sub = F.floor(F.col("_cell") / width)
        low = F.col("_cell") % width
        held = F.least(F.lit(width), F.col("_cells") - sub * width)
        lows = F.when((held < width) & (sub % fanout > 0), F.sequence(low, F.lit(width - 1).cast("bigint"), held))
        sent = nodes.select(
            "*", sub.alias("_sub"), F.floor(sub / fanout).alias("_over"),
            F.explode(F.coalesce(lows, F.array(low))).alias("_low"),
        )
        at_home = F.col("_cell") % width == F.col("_low")
        swapped = sent.groupBy("group", "_over", "_low").agg(
            F.sort_array(F.collect_list(F.struct("_sub", "_root"))).alias("_roots"),
            F.collect_list(F.when(at_home, F.struct("_cell", "_cells", "_sub", "_path"))).alias("_members"),
        )
        swapped = swapped.select("group", "_roots", F.inline("_members"))
        side = lambda keep: _joined(F.transform(F.filter("_roots", keep), lambda x: x["_root"]))
        step = F.struct(
            side(lambda x: x["_sub"] < F.col("_sub")).alias("before"),
            side(lambda x: x["_sub"] > F.col("_sub")).alias("after"),
        )
        several = F.col("_cells") > width
        nodes = swapped.select(
            "group", "_cell", "_cells",
            F.when(several, digest(side(lambda x: F.lit(True)))).otherwise(F.get("_roots", F.lit(0))["_root"]).alias("_root"),
            F.when(several, F.concat("_path", F.array(step))).otherwise(F.col("_path")).alias("_path"),
        )
        width *= fanout
    return nodes.drop("_cells")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path lead to."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["before"], node, step["after"]))


def dataset_manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """A row per row of `docs`: doc_id, source, leaf, subroot (of the source), root, path, tampered_leaf.

    Leaves ascend by doc_id inside a source; null ids come first, and rows with equal ids ascend by
    digest. A null source is a source of its own, in front of all others. `tampered`
    replaces the text of tampered_leaf (null: the row is left as it is). Columns beside those of a
    leaf are ignored; an empty table has no rows.
    """
    columns = {c: F.col(c) for c in LEAF_COLUMNS}
    leaf = leaf_digest(**columns)
    other = leaf if tampered is None else F.when(tampered.isNull(), leaf).otherwise(leaf_digest(**columns | {"text": tampered}))
    rows = docs.select(
        "doc_id", "source", leaf.alias("leaf"), other.alias("tampered_leaf"),
        # keeps the order of sources, null in front
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-")).alias("group"),
    )
    inner = materialise(manifest(rows, ["doc_id"]).withColumnRenamed("root", "subroot"), "proofs")
    subroots = inner.groupBy("group").agg(F.first("subroot").alias("leaf")).withColumnRenamed("group", "source_key")
    top = manifest(subroots.withColumn("group", F.lit("")), ["source_key"])
    top = top.select(F.col("source_key").alias("group"), "root", F.col("path").alias("_above"))
    found = attach(inner, top, ["group"], spread_by=["doc_id", "leaf"])
    return found.select(
        "doc_id", "source", "leaf", "subroot", "root", F.concat("path", "_above").alias("path"), "tampered_leaf"
    )


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return digest(_joined(F.transform(path, lambda s: F.concat(s["before"], s["after"]))))


def verified_documents(docs: DataFrame) -> DataFrame:
    """Proofs of `docs`, folded from a leaf whose text has been lower-cased for a fifth of the ids.

    That fifth: 5 divides crc32 of the id's digits; rows without an id are never tampered with, and a
    null text stays null.
    """
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    found = dataset_manifest(docs, F.when(chosen, lower))
    end = folded(F.col("tampered_leaf"), F.col("path"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), end.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def manifest_sql(levels: int = 7) -> str:
    """The same for DuckDB, for sources of up to 16^levels documents."""
    n = FANOUT

    def tree(name: str, order: str) -> list[str]:
        """CTEs up from {name}0 (g, k, h): nodes, and what each climbs past."""
        out = [f"{name}n0 AS (SELECT g, row_number() OVER (PARTITION BY g ORDER BY {order}) - 1 AS pos, * EXCLUDE (g) FROM {name}0)"]
        for i in range(levels):
            out.append(
                f"""{name}s{i} AS (SELECT g, pos, h, count(*) OVER (PARTITION BY g) AS n,
  coalesce(string_agg(h, '') OVER (PARTITION BY g, pos // {n} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
  coalesce(string_agg(h, '') OVER (PARTITION BY g, pos // {n} ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
  FROM {name}n{i}),
{name}n{i + 1} AS (SELECT g, pos // {n} AS pos, CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE max(h) END AS h
  FROM {name}s{i} GROUP BY g, pos // {n})"""
            )
        joins = "".join(f" JOIN {name}s{i} AS s{i} ON s{i}.g = n.g AND s{i}.pos = n.pos // {n**i}" for i in range(levels))
        proof = " || ".join(f"CASE WHEN s{i}.n > 1 THEN s{i}.b || s{i}.a ELSE '' END" for i in range(levels))
        steps = ", ".join(f"CASE WHEN s{i}.n > 1 THEN [s{i}.b, s{i}.a] END" for i in range(levels))
        out.append(
            f"""{name} AS (SELECT n.*, top.h AS top, {proof} AS proof, list_filter([{steps}], lambda x: x IS NOT NULL) AS steps
  FROM {name}n0 AS n{joins} JOIN {name}n{levels} AS top ON top.g = n.g)"""
        )
        return out

    def leaf(text: str) -> str:
        columns = [f"CAST({c} AS VARCHAR)" if c != "text" else text for c in LEAF_COLUMNS]
        return "sha256(" + " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in columns) + ")"

    digits = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))"
    bit = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    eight = "[CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]"
    crc = f"""xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {digits}),
  lambda a, b: list_reduce(list_prepend(xor(a, b), {eight}), lambda x, y: {bit})), 4294967295)"""
    lower = f"CASE WHEN {crc} % 5 = 0 THEN translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}') ELSE text END"
    fold = "list_reduce(list_prepend([t], steps), lambda x, y: [sha256(y[1] || x[1] || y[2])])[1]"
    return f"""
WITH d AS (SELECT *, {lower} AS other FROM documents),
u0 AS (SELECT coalesce('=' || source, '-') AS g, doc_id, {leaf("text")} AS h, {leaf("other")} AS t FROM d),
{", ".join(tree("u", "doc_id NULLS FIRST, h"))},
v0 AS (SELECT '' AS g, g AS k, max(top) AS h FROM u GROUP BY 2),
{", ".join(tree("v", "k"))},
w AS (SELECT u.doc_id, u.h AS leaf, u.top AS subroot, v.top AS root, u.t,
  sha256(u.proof || v.proof) AS proof_sha256, list_concat(u.steps, v.steps) AS steps
  FROM u JOIN v ON v.k = u.g)
SELECT doc_id, leaf, subroot, root, proof_sha256, {fold} AS folded_root, {fold} = root AS verified FROM w"""
