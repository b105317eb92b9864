"""Merkle manifest of a table: a tree per source, and one over the sources' roots.

Nodes are labelled by the interval of leaf ranks that they cover, nested as the tree is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termscope.operators.numbering import global_rank
from termscope.sources.storage import join_by_size, stored

#: Children of a node, and what a leaf is made of.
FANOUT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: Levels that are built from one another within a row and attached by one join. A row
#: of a band holds at most FANOUT ** BAND digests.
BAND = 4

#: Powers of the fan-out up to the largest bigint.
_POWERS = [FANOUT**i for i in range(40) if FANOUT**i < 1 << 63]


def field_text(column: str) -> Column:
    """Byte count, colon and value; a null is a hyphen."""
    value = F.col(column).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(text: Column | None = None) -> Column:
    """SHA-256 of a row's fields, optionally with another text."""
    fields = [field_text(c) for c in FIELDS[:-1]]
    if text is None:
        last = field_text("text")
    else:
        last = F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return _sha(F.concat(*fields, last))


def _sha(text: Column) -> Column:
    """The digest of a text, as bytes: half the size of the letters it stands for."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _letters(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(digests: Column) -> Column:
    return _sha(F.array_join(F.transform(digests, _letters), ""))


def _run_together(kids: Column) -> Column:
    """The digests of at most FANOUT - 1 children as one run of bytes."""
    nothing = F.lit(b"")
    parts = [F.coalesce(F.get(kids, F.lit(i))["digest"], nothing) for i in range(FANOUT - 1)]
    return F.concat(*parts)


def _power(level: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, _POWERS)), level.cast("int") + 1)


def _height(count: Column) -> Column:
    """Levels above the leaves until one node is left."""
    below = F.filter(F.array(*map(F.lit, _POWERS)), lambda p: p < count)
    return F.size(below)


def _parents(digests: Column) -> Column:
    """Digests of the next level: of every FANOUT consecutive ones, the last run shorter."""
    runs = F.sequence(F.lit(0), (F.size(digests) - 1).cast("int"), F.lit(FANOUT))
    return F.transform(runs, lambda i: _joined(F.slice(digests, i + 1, FANOUT)))


def _intervals(digests: Column, level: int) -> Column:
    """Labelled nodes of one level of a band, given those of its bottom."""
    width = FANOUT**level
    return F.transform(
        digests,
        lambda d, i: F.struct(
            F.lit(level).alias("rise"),
            (F.col("first") + i * width).alias("at"),
            d.alias("digest"),
        ),
    )


def _band(bottom: DataFrame, low: int) -> DataFrame:
    """Nodes of up to BAND levels above ``low``, from the nodes of that level.

    ``bottom`` and the result have ``(tree, level, lo, hi, digest, size, height)``: a node
    covers the leaves of rank lo to hi of its tree, which has ``size`` leaves.
    """
    place = F.expr(f"lo div {FANOUT**low}")
    block = F.expr(f"lo div {FANOUT ** (low + BAND)}")
    rows = (
        bottom.where(F.col("height") > low)
        .groupBy("tree", block.alias("block"), "size", "height")
        .agg(F.sort_array(F.collect_list(F.struct(place.alias("i"), "digest"))).alias("nodes"))
        .select(
            "tree", "size", "height",
            F.col("nodes.digest").alias("d0"),
            (F.col("block") * FANOUT**BAND).alias("first"),
        )
    )
    for k in range(1, BAND + 1):
        rows = rows.withColumn(f"d{k}", _parents(F.col(f"d{k - 1}")))
    labelled = F.concat(*(_intervals(F.col(f"d{k}"), k) for k in range(1, BAND + 1)))
    nodes = rows.select("tree", "size", "height", F.explode(labelled).alias("n"))
    level = F.col("n.rise") + low
    lo = F.col("n.at") * FANOUT**low
    return nodes.select(
        "tree",
        level.alias("level"),
        lo.alias("lo"),
        F.least(lo + _power(level) - 1, F.col("size") - 1).alias("hi"),
        F.col("n.digest").alias("digest"),
        "size",
        "height",
    ).where("level <= height")


def nodes(leaves: DataFrame) -> list[DataFrame]:
    """All nodes of the trees over ``leaves (tree, rank, digest, size)``, band by band.

    The first of the list are the leaves themselves, each other one up to BAND levels.
    Digests of a band are made from arrays of bounded length, so a large tree is built by
    many tasks, and the number of rounds is its height over BAND.
    """
    bottom = leaves.select(
        "tree",
        F.lit(0).alias("level"),
        F.col("rank").alias("lo"),
        F.col("rank").alias("hi"),
        "digest",
        "size",
        _height(F.col("size")).alias("height"),
    )
    out = [bottom]
    top = out[0].agg(F.coalesce(F.max("height"), F.lit(0))).first()[0]
    for low in range(0, top, BAND):
        at = out[-1].where(F.col("level") == low)
        out.append(stored(_band(at, low), "nodes"))
    return out


def _families(band: list[DataFrame], low: int) -> DataFrame:
    """``(tree, level, lo, kids)``: each node above ``low`` with the intervals below it.

    Children lie in the interval of their parent: the buckets of a level are its nodes'
    widths, so containment is an equality of bucket numbers.
    """
    below = band[0].where(f"level = {low}").unionByName(
        band[1].where(f"level < {low + BAND}")
    )
    parent = F.col("level") + 1
    width = _power(parent)
    return (
        below.where("level < height")
        .groupBy("tree", parent.alias("level"), (F.floor(F.col("lo") / width) * width).alias("lo"))
        .agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("kids"))
    )


def _paths(band: list[DataFrame], low: int) -> DataFrame:
    """``(tree, lo, path)`` of the nodes at ``low``: siblings on the way up the band.

    Each step of a path has the digests left and right of the way, joined to one text.
    """
    bottom = band[0].where(f"level = {low} and height > {low}")
    levels = F.sequence(
        F.lit(low + 1), F.least(F.lit(low + BAND), F.col("height"))
    )
    wanted = bottom.select("tree", F.col("lo").alias("own"), F.explode(levels).alias("level"))
    width = _power(F.col("level"))
    wanted = wanted.withColumn("lo", F.floor(F.col("own") / width) * width)
    met = wanted.join(_families(band, low), ["tree", "level", "lo"])
    # What is left of the parent's interval without the child's that holds the node.
    left = F.filter("kids", lambda k: k["hi"] < F.col("own"))
    right = F.filter("kids", lambda k: k["lo"] > F.col("own"))
    step = F.struct(
        "level",
        _run_together(left).alias("left"),
        _run_together(right).alias("right"),
    )
    return met.groupBy("tree", F.col("own").alias("lo")).agg(
        F.sort_array(F.collect_list(step)).alias("path")
    )


def paths(bands: list[DataFrame], above: DataFrame, leaves: DataFrame) -> DataFrame:
    """``leaves (tree, rank, ...)`` and ``path``, up to the root and on with ``above``.

    ``above (tree, path)`` is what goes on where a tree ends. A band's paths are joined
    with those of its topmost nodes, from the top band down. Leaves meet the few steps of
    the lowest band first; the long rest is shared by all leaves of a block and is not
    shuffled with each of them.
    """
    whole = bands[0].select("tree", "size", "height").where("lo = 0")
    ends = whole.join(above, "tree").select(
        "tree", F.col("height").alias("level"), F.lit(0).cast("bigint").alias("lo"), "path"
    )
    ends = stored(ends, "ends")
    known = ends
    for b in reversed(range(len(bands) - 1)):
        low = b * BAND
        own = _paths([bands[b], bands[b + 1]], low)
        if b:
            sized = bands[b].where(f"level = {low} and height > {low}")
            sized = sized.select("tree", F.col("lo").alias("own"), "height")
        else:
            sized = leaves.withColumn("own", F.col("rank")).withColumn("height", _height(F.col("size")))
            sized = sized.where("height > 0")
        own = own.select("tree", F.col("lo").alias("own"), F.col("path").alias("first"))
        top = F.least(F.lit(low + BAND), F.col("height"))
        placed = own.join(sized, ["tree", "own"]).withColumn("level", top).drop("height")
        width = _power(F.col("level"))
        placed = placed.withColumn("lo", F.floor(F.col("own") / width) * width)
        found = placed.join(known, ["tree", "level", "lo"]).withColumn("path", F.concat("first", "path"))
        if b:
            found = found.select("tree", F.lit(low).alias("level"), F.col("own").alias("lo"), "path")
            known = stored(found.unionByName(ends.where(f"level <= {low}")), "paths")
        else:
            found = found.select(*leaves.columns, "path")
    alone = leaves.where("size = 1").join(ends.where("level = 0").select("tree", "path"), "tree")
    alone = alone.select(*leaves.columns, "path")
    return found.unionByName(alone) if len(bands) > 1 else alone


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(
        path,
        leaf,
        lambda acc, step: _sha(
            F.concat(_letters(step["left"]), _letters(acc), _letters(step["right"]))
        ),
    )


def _is_tampered(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0


def _empty_path() -> Column:
    return F.array().cast("array<struct<level:int,left:binary,right:binary>>")


def manifest(docs: DataFrame) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` per row.

    A leaf is the digest of its row's fields; leaves of a source ascend by doc_id, a null
    one first and equal ids by their digest; sources ascend by bytes, a null one first.
    ``proof_sha256`` is the digest of all siblings on the way to the root.
    ``folded_root`` follows that way from the row as it is after tampering, which deletes
    the newlines of texts whose doc_id has an even CRC-32 (a null id has none and is
    never tampered with).

    Every row has its leaf, repeated ones too; a null, empty or long text is hashed as it
    is. A table without rows gives none. Other columns are not looked at. Ranks come from
    a range partition, so a source that holds a third of all rows is dealt to many tasks,
    and trees are cut into blocks of at most 81 nodes. Runs jobs when it is called.
    """
    # No text starts with what marks a null, and marks sort as nulls and texts do.
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))
    leaf = leaf_digest()
    cut = leaf_digest(F.replace("text", F.lit("\n"), F.lit("")))
    changed = _is_tampered(F.col("doc_id")) & (F.instr("text", "\n") > 0)
    rows = docs.select(
        F.col("doc_id"),
        key.alias("key"),
        leaf.alias("leaf"),
        F.when(changed, cut).alias("tampered"),
    )
    order = [F.asc("key"), F.asc_nulls_first("doc_id"), F.asc("leaf")]
    ranked = global_rank(stored(rows, "rows"), order, "place")
    sizes = ranked.groupBy("key").agg(F.min("place").alias("start"), F.count("*").alias("size"))
    trees = stored(global_rank(sizes, [F.asc("key")], "tree"), "trees")
    leaves = join_by_size(ranked, trees, "key", "trees").select(
        "tree", (F.col("place") - F.col("start")).alias("rank"), "size", "doc_id", "leaf", "tampered"
    )
    leaves = stored(leaves, "placed")
    bands = nodes(leaves.select("tree", "rank", F.col("leaf").alias("digest"), "size"))
    roots = [b.where("level = height").select("tree", F.col("digest").alias("subroot")) for b in bands]
    subroots = roots[0]
    for more in roots[1:]:
        subroots = subroots.unionByName(more)
    subroots = stored(subroots, "subroots")
    count = subroots.count()
    top = nodes(
        subroots.select(
            F.lit(0).cast("bigint").alias("tree"),
            (F.col("tree") - 1).alias("rank"),
            F.col("subroot").alias("digest"),
            F.lit(count).cast("bigint").alias("size"),
        )
    )
    end = top[-1].where("level = height").select("tree", F.col("digest").alias("root"))
    nothing = end.select("tree", _empty_path().alias("path"))
    over = paths(top, nothing, top[0].select("tree", F.col("lo").alias("rank"), "size"))
    over = over.select((F.col("rank") + 1).alias("tree"), "path")
    # One row: the root of all.
    root = end.select("root").scalar()
    found = join_by_size(paths(bands, over, leaves), subroots, "tree", "subroots")
    siblings = F.array_join(
        F.transform("path", lambda s: F.concat(_letters(s["left"]), _letters(s["right"]))), ""
    )
    folded = fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.select(
        "doc_id",
        _letters(F.col("leaf")).alias("leaf"),
        _letters(F.col("subroot")).alias("subroot"),
        _letters(root).alias("root"),
        F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
        _letters(folded).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


#: Deepest tree that the SQL below builds: 3 ** 20 leaves a source.
_SQL_LEVELS = 20

_CRC = """list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END))"""


def _sql_field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _sql_leaf(text: str) -> str:
    return f"sha256({' || '.join(_sql_field(c) for c in (*FIELDS[:-1], text))})"


def _sql_tree(name: str, base: str) -> str:
    """All nodes above ``base (tree, i, d, n)``, with the nodes of each level left in n."""
    return f"""{name} AS (
  SELECT 0 AS level, tree, i, d, n FROM {base}
  UNION ALL
  SELECT level + 1, tree, i // 3, sha256(string_agg(d, '' ORDER BY i)), (n + 2) // 3
  FROM {name} WHERE n > 1 AND level < {_SQL_LEVELS}
  GROUP BY level, tree, i // 3, n)"""


def _sql_path(name: str, tree: str, base: str, level: str = "0") -> str:
    """Steps (level, left, right) of every node of ``base (tree, i, n)``."""
    return f"""{name} AS (
  SELECT b.tree, b.i, t.level,
         coalesce(string_agg(t.d, '' ORDER BY t.i) FILTER (WHERE t.i < b.i // pow3(t.level)), '') AS l,
         coalesce(string_agg(t.d, '' ORDER BY t.i) FILTER (WHERE t.i > b.i // pow3(t.level)), '') AS r
  FROM {base} b JOIN {tree} t
    ON t.tree = b.tree AND t.n > 1 AND t.i // 3 = b.i // pow3(t.level + 1)
  GROUP BY b.tree, b.i, t.level)""".replace("pow3(t.level + 1)", "CAST(3 ** (t.level + 1) AS BIGINT)").replace(
        "pow3(t.level)", "CAST(3 ** t.level AS BIGINT)"
    )


#: The same in DuckDB.
MANIFEST_SQL = f"""
WITH RECURSIVE sources AS (
  SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) AS n
  FROM documents GROUP BY source),
hashed AS (
  SELECT doc_id, source, {_sql_leaf("text")} AS d,
         CASE WHEN ({_CRC}) % 2 = 1 THEN {_sql_leaf("replace(text, chr(10), '')")} END AS t
  FROM documents),
leaves AS (
  SELECT tree, n, doc_id, d, t,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, d) - 1 AS i
  FROM hashed JOIN sources ON hashed.source IS NOT DISTINCT FROM sources.source),
{_sql_tree("forest", "leaves")},
{_sql_path("low", "forest", "leaves")},
subroots AS (SELECT tree AS i, d, 0 AS tree, (SELECT count(*) FROM sources) AS n
             FROM forest WHERE n = 1),
{_sql_tree("crown", "subroots")},
{_sql_path("high", "crown", "subroots")},
root AS (SELECT d FROM crown WHERE n = 1),
steps AS (
  SELECT tree, i, level, l, r FROM low
  UNION ALL
  SELECT leaves.tree, leaves.i, 1000 + level, l, r
  FROM leaves JOIN high ON leaves.tree = high.i),
proofs AS (
  SELECT tree, i, string_agg(l || r, '' ORDER BY level) AS siblings,
         list({{'l': l, 'r': r, 'acc': ''}} ORDER BY level) AS path
  FROM steps GROUP BY tree, i),
found AS (
  SELECT doc_id, leaves.d AS leaf, subroots.d AS subroot, root.d AS root,
         sha256(coalesce(siblings, '')) AS proof_sha256,
         list_reduce(
           list_prepend({{'l': '', 'r': '', 'acc': coalesce(leaves.t, leaves.d)}},
                        coalesce(path, [])),
           lambda a, s: {{'l': '', 'r': '', 'acc': sha256(s.l || a.acc || s.r)}}).acc AS folded_root
  FROM leaves JOIN subroots ON leaves.tree = subroots.i CROSS JOIN root
  LEFT JOIN proofs ON proofs.tree = leaves.tree AND proofs.i = leaves.i)
SELECT *, folded_root = root AS verified FROM found"""
