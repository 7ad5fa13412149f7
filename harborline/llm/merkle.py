"""Merkle manifest of a table by nested-interval labels.

Every row is a leaf; a language's leaves stand in order of their ids, and every node is labelled with the interval of leaf
ranks it covers. A tree is built in bands of `bits` levels: leaves meet in buckets of 2 ** bits ranks, a row each, whose
nodes follow from their children's intervals; a bucket's top is an item of the next band. Two children differ from their
parent by an interval: what a parent covers beyond a node is that node's sibling. Ancestors are attached by joins on the
bucket of a band's levels and containment of the leaf in the node's interval. A leaf's path takes the join of its own
band; what lies above is attached to its bucket once, whatever the number of leaves.

Texts are hashed where they are read; only ids and digests of 32 bytes travel. No task holds more than one range of leaves
or one bucket, however many rows a language has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, few, written

BITS = 8  # levels of a band: a bucket holds at most 2 ** BITS items
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "array<array<struct<lo:bigint,hi:bigint,digest:binary>>>"
STEP = "struct<left:boolean,digest:binary>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of strings, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def hexed(c: Column) -> Column:
    return F.lower(F.hex(c))


def encoded(c: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value."""
    s = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(fields: tuple = FIELDS, **instead: Column) -> Column:
    """Digest of a row; `instead` puts another value in a field's place."""
    return digest(*[encoded(instead.get(f, F.col(f"`{f}`"))) for f in fields])


def tampered() -> Column:
    """n_chars as tampering leaves it: one more where 7 divides the crc32 of the id in decimals; nulls stay."""
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))


def ranked(rows: DataFrame, group: str, by: list[str]) -> DataFrame:
    """rows with `rank` (from 0, in order of `by`) and `n` (rows) within their group, which is not null.

    Rows are sorted in ranges of the group and `by`, so a group spreads over many tasks; a row for each range and group
    gives the offsets. rows should be cheap to read twice, as ranges come from a sample of them.
    """
    placed = written(rows.repartitionByRange(group, *by).sortWithinPartitions(group, *by).withColumn("at", F.monotonically_increasing_id()), "ranks")
    part = F.shiftright("at", 33)
    counts = placed.groupBy(F.col(group).alias("of_group"), part.alias("of_part")).agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    whole = Window.partitionBy("of_group")
    before = F.coalesce(F.sum("rows").over(whole.orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = written(counts.select("of_group", "of_part", (before - F.col("first")).alias("shift"), F.sum("rows").over(whole).alias("n")), "offsets")
    joined = placed.join(few(offsets), (F.col(group) == F.col("of_group")) & (part == F.col("of_part")))
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("at") + F.col("shift")).alias("rank"), "n")


def levels_of(bits: int) -> Column:
    """Levels above n items within a band."""
    return F.expr(f"case when n > {1 << bits} then {bits} when n < 2 then 0 else length(bin(n - 1)) end")


def band(items: DataFrame, bits: int) -> DataFrame:
    """Nodes of the band over items (g, rank, lo, hi, digest, n): a row each with its interval, its sibling and the items' n.

    Rows: g, n, depth (levels of the group in this band), level (0: the items), rank within the level, lo, hi, digest,
    sibling (null: none in this band) and left (the sibling stands left). Buckets of 2 ** bits items are rows of their own.
    """
    buckets = items.groupBy("g", F.shiftright("rank", bits).alias("bucket"), "n").agg(F.sort_array(F.collect_list(F.struct("rank", "lo", "hi", "digest"))).alias("members"))
    last = "element_at(levels, -1)"
    pair = f"""named_struct('lo', get({last}, 2 * i).lo, 'hi', coalesce(get({last}, 2 * i + 1).hi, get({last}, 2 * i).hi),
        'digest', unhex(sha2(concat(lower(hex(get({last}, 2 * i).digest)), coalesce(lower(hex(get({last}, 2 * i + 1).digest)), '')), 256)))"""
    upper = f"cast(concat(levels, array(transform(sequence(0, cast((size({last}) + 1) div 2 - 1 as int)), i -> {pair}))) as {NODE})"
    base = f"cast(array(transform(members, m -> named_struct('lo', m.lo, 'hi', m.hi, 'digest', m.digest))) as {NODE})"
    built = buckets.select("g", "n", "bucket", levels_of(bits).alias("depth"), F.expr(base).alias("base"))
    built = built.select("g", "n", "bucket", "depth", F.expr(f"case when depth = 0 then base else aggregate(sequence(1, depth), base, (levels, k) -> {upper}) end").alias("levels"))
    level = built.select("g", "n", "bucket", "depth", F.posexplode("levels").alias("level", "nodes"), F.expr("get(levels, level + 1)").alias("parents"))
    node = level.select("*", F.posexplode("nodes").alias("i", "node")).select("*", F.expr("get(parents, i div 2)").alias("parent"))
    # the parent's interval less the node's: a piece on the left, one on the right, or none
    piece = node.withColumn("left", F.expr("parent.lo < node.lo"))
    sibling = F.expr("case when parent.lo < node.lo then get(nodes, i - 1) when node.hi < parent.hi then get(nodes, i + 1) end")
    piece = piece.withColumn("sibling", sibling).withColumn("rank", F.expr(f"shiftleft(bucket, {bits} - level) + i"))
    return piece.select("g", "n", "depth", "level", "rank", "node.lo", "node.hi", "node.digest", F.col("sibling.digest").alias("sibling"), "left")


def attached(items: DataFrame, nodes: DataFrame, bits: int) -> DataFrame:
    """(g, top, rank, n, kept, path): each item with its siblings below the band's top, from the bottom up.

    Items meet the nodes of their bucket of the band's levels, and the nodes that contain them stay: those are their
    ancestors, whose siblings make the path. One shuffle by the bucket serves the join and what follows it.
    """
    at = items.select("g", F.shiftright("rank", bits).alias("top"), "rank", "n", F.col("lo").alias("at"), "kept")
    label = nodes.where("level < depth").select("g", F.expr(f"shiftright(rank, {bits} - level)").alias("top"), "level", "lo", "hi", F.struct("left", F.col("sibling").alias("digest")).alias("step"))
    held = at.alias("i").join(label.alias("a"), (F.col("i.g") == F.col("a.g")) & (F.col("i.top") == F.col("a.top")) & F.expr("a.lo <= i.at and i.at < a.hi"), "left")
    steps = F.sort_array(F.collect_list(F.when(F.col("a.level").isNotNull(), F.struct("a.level", "a.step"))))
    out = held.groupBy("i.g", "i.top", "i.rank", "i.n").agg(F.first("i.kept").alias("kept"), F.transform(steps, lambda x: x.step).alias("path"))
    return out.withColumn("path", F.col("path").cast(f"array<{STEP}>"))


def tree(items: DataFrame, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """Of items (g, rank, lo, hi, digest, n, kept): (g, rank, kept, path), and (g, digest) of each group's top.

    A path's steps are the siblings from the item to the top, with a null digest where a node has none.
    """
    nodes = written(band(items, bits), "nodes")
    own = attached(items, nodes, bits)
    done = nodes.where(f"n <= {1 << bits} and level = depth").select("g", "digest")
    most = nodes.agg(F.max("n")).first()[0] or 0
    if most <= 1 << bits:
        return own.select("g", "rank", "kept", "path"), done
    above = nodes.where(f"n > {1 << bits} and level = depth")
    above = above.select("g", "rank", "lo", "hi", "digest", F.expr(f"shiftright(n + {(1 << bits) - 1}, {bits})").alias("n"), F.lit(None).cast("int").alias("kept"))
    upper, tops = tree(above, bits)
    upper = upper.select("g", F.col("rank").alias("top"), F.col("path").alias("upper"))
    whole = own.join(upper, ["g", "top"], "left")
    return whole.select("g", "rank", "kept", F.concat("path", F.coalesce("upper", F.array().cast(f"array<{STEP}>"))).alias("path")), done.union(tops)


def folded(start: Column, path: Column) -> Column:
    """The digest (hex) that a leaf (hex) and the siblings of its path give."""
    step = lambda acc, s: F.sha2(F.when(s.digest.isNull(), acc).when(s.left, F.concat(hexed(s.digest), acc)).otherwise(F.concat(acc, hexed(s.digest))), 256)
    return F.aggregate(path, start, step)


def proof(path: Column) -> Column:
    """Digest of a path's siblings, in its order."""
    return F.sha2(F.array_join(F.transform(F.filter(path, lambda s: s.digest.isNotNull()), lambda s: hexed(s.digest)), ""), 256)


def manifest(docs: DataFrame, claimed: Column | None = None, bits: int = BITS) -> DataFrame:
    """One row for each row of docs: doc_id, lang, leaf, shown (binary), subroot, root, path.

    `shown` is the leaf with `claimed` in place of n_chars, the leaf itself where that is the same. path: the siblings up
    to the language's subroot, then up to the root. Rows with one id stand in order of their leaves (equal rows: in any,
    their digests are the same); null ids come first, as does the null language. Nulls, empty and very long texts are
    values like others; a table without rows gives none; columns but the five are not covered, whatever their names.
    """
    d = docs.select(*[F.col(f"`{f}`") for f in FIELDS])
    own = F.unhex(leaf())
    shown = F.unhex(leaf(n_chars=claimed)) if claimed is not None else own
    d = d.select("doc_id", F.coalesce(F.concat(F.lit("+"), F.col("lang").cast("string")), F.lit("")).alias("g"), own.alias("leaf"), F.when(claimed.eqNullSafe(F.col("n_chars")), None).otherwise(shown).alias("shown") if claimed is not None else F.lit(None).cast("binary").alias("shown"))
    hashed = written(d, "leaves")
    rows = written(ranked(hashed, "g", ["doc_id", "leaf"]), "ranked")
    discard(hashed)
    items = lambda r, *kept: r.select("g", "rank", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest", "n", F.struct(*kept).alias("kept"))
    paths, tops = tree(items(rows.withColumn("digest", F.col("leaf")), "doc_id", "leaf", "shown"), bits)
    tops = written(tops, "subroots")
    langs = written(ranked(tops.withColumn("one", F.lit("")).withColumnRenamed("g", "of"), "one", ["of"]).withColumnRenamed("one", "g"), "languages")
    above, top = tree(items(langs, "of", "digest"), bits)
    of = above.join(top.withColumnRenamed("digest", "root"), "g").select(F.col("kept.of").alias("g"), F.col("kept.digest").alias("subroot"), "root", F.col("path").alias("above"))
    out = paths.join(few(written(of, "roots"), 10_000), "g")
    lang = F.when(F.col("g") != "", F.expr("substring(g, 2)"))
    return out.select("kept.doc_id", lang.alias("lang"), "kept.leaf", F.coalesce("kept.shown", "kept.leaf").alias("shown"), "subroot", "root", F.concat("path", "above").alias("path"))


def audit(docs: DataFrame, claimed: Column | None = None, bits: int = BITS) -> DataFrame:
    """The manifest of docs with digests as hex text, and whether the rows as claimed still lead to its root."""
    m = manifest(docs, tampered() if claimed is None else claimed, bits)
    m = m.select("doc_id", hexed(F.col("leaf")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"), hexed(F.col("root")).alias("root"), proof(F.col("path")).alias("proof_sha256"), folded(hexed(F.col("shown")), F.col("path")).alias("folded_root"))
    return m.withColumn("verified", F.col("folded_root") == F.col("root"))


_CRC = "list_reduce(string_split(cast(doc_id as varchar), ''), lambda acc, b: xor(acc >> 8, list_reduce(range(8), lambda c, i: xor(c >> 1, (c & 1) * 3988292384), xor(acc, b) & 255)), cast(4294967295 as bigint))"
_CRC = _CRC.replace("string_split(cast(doc_id as varchar), '')", "list_transform(string_split(cast(doc_id as varchar), ''), lambda z: cast(ascii(z) as bigint))")
_VALUE = "case when {0} is null then '-' else strlen(cast({0} as varchar)) || ':' || cast({0} as varchar) end"
_HEAD = " || ".join(_VALUE.format(f) for f in ("doc_id", "source", "lang"))

ORACLE_SQL = f"""with recursive claims as (select *, case when xor({_CRC}, 4294967295) % 7 = 0 then n_chars + 1 else n_chars end as claimed from documents),
    leaves as (select row_number() over (order by lang nulls first, doc_id nulls first) as row, doc_id, coalesce('+' || lang, '') as g, sha256({_HEAD} || {_VALUE.format("n_chars")} || {_VALUE.format("text")}) as leaf, sha256({_HEAD} || {_VALUE.format("claimed")} || {_VALUE.format("text")}) as shown from claims),
    ranked as (select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as rank, count(*) over (partition by g) as n from leaves),
    nodes as (
      select g, 0 as level, rank, n, leaf as digest from ranked
      union all select g, level + 1, rank // 2, (n + 1) // 2, sha256(string_agg(digest, '' order by rank)) from nodes where n > 1 group by g, level, rank // 2, (n + 1) // 2),
    climb as (
      select row, g, 0 as level, rank, n, shown as folded, '' as proof from ranked
      union all select c.row, c.g, c.level + 1, c.rank // 2, (c.n + 1) // 2, sha256(case when s.digest is null then c.folded when s.rank < c.rank then s.digest || c.folded else c.folded || s.digest end), c.proof || coalesce(s.digest, '')
        from climb c left join nodes s on s.g = c.g and s.level = c.level and s.rank = xor(c.rank, 1) where c.n > 1),
    subroots as (select g, digest, row_number() over (order by g) - 1 as rank, count(*) over () as n from nodes where n = 1),
    tops as (
      select 0 as level, rank, n, digest from subroots
      union all select level + 1, rank // 2, (n + 1) // 2, sha256(string_agg(digest, '' order by rank)) from tops where n > 1 group by level, rank // 2, (n + 1) // 2),
    ascent as (
      select c.row, 0 as level, s.rank, s.n, c.folded, c.proof from climb c join subroots s on s.g = c.g where c.n = 1
      union all select c.row, c.level + 1, c.rank // 2, (c.n + 1) // 2, sha256(case when s.digest is null then c.folded when s.rank < c.rank then s.digest || c.folded else c.folded || s.digest end), c.proof || coalesce(s.digest, '')
        from ascent c left join tops s on s.level = c.level and s.rank = xor(c.rank, 1) where c.n > 1)
    select r.doc_id, r.leaf, s.digest as subroot, t.digest as root, sha256(a.proof) as proof_sha256, a.folded as folded_root, a.folded = t.digest as verified
    from ranked r join ascent a on a.row = r.row and a.n = 1 join subroots s on s.g = r.g join tops t on t.n = 1"""
