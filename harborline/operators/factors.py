"""Fitting of licensed links without a row a link: a mass is a source's factor, times the prior, times a target's factor.

A link's prior depends on both codes' names alone, and names repeat; which codes are linked depends on their headings and on
whether they stay. So what a code's factor needs are sums by heading and name: steps take time by the pairs of headings and names,
and what is shuffled, held and written follows the codes and the pairs of headings. Links are only counted, or made where they
are returned.
"""

from __future__ import annotations

import dataclasses

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns
from ..sources.store import written
from . import fitting, graph

NAMES = 2_000  # names of a side; the similarities of their pairs are numbers that every task holds (8 bytes each)
CODES = 8_000_000  # codes of a connected group that a task holds as numbers (some 100 bytes each)
CELLS = 16_000_000  # headings times names of a group (8 bytes each, some eight tables)
LINKS = 100_000_000  # about as many links a task tries where they are returned


@dataclasses.dataclass
class Fitted:
    """codes: (side, hs10, head, stays, name, factor, exponent, mass, own), a row for each linked code of either side.

    A target ('b') has its factor (times two to the exponent), the mass that its links bring and that of its own link. A source
    ('a') has the sum of its links' priors times the targets' factors in place of a factor, and its own link's share of it. met: (hs6_past, hs6) with
    the codes past, gone, now and new of either heading. near: similarities of names. links: their number.
    """

    codes: DataFrame
    met: DataFrame
    near: np.ndarray
    links: int


def _sizes(c: DataFrame) -> DataFrame:
    one = lambda kind: F.count_if(F.expr(kind))
    return c.where("hs10 is not null").groupBy("head").agg(one("past").alias("past"), one("past and not stays").alias("gone"), one("now").alias("now"), one("now and not stays").alias("new"), one("stays").alias("stay"))


def _met(c: DataFrame, heads: DataFrame) -> tuple[DataFrame, int]:
    """Pairs of headings with links between their codes, and the number of all links, own ones included."""
    n = _sizes(c)
    a, b = n.select(F.col("head").alias("hs6_past"), "past", "gone"), n.select(F.col("head").alias("hs6"), "now", "new")
    met = written(heads.join(a, "hs6_past").join(b, "hs6").where("gone * now + (past - gone) * new > 0"), "met")
    links = met.agg(F.sum(F.expr("gone * now + (past - gone) * new"))).first()[0] or 0
    return met, links + (n.agg(F.sum("stay")).first()[0] or 0)


def _linked(c: DataFrame, met: DataFrame, names: tuple[DataFrame, DataFrame], values: tuple[DataFrame, DataFrame]) -> DataFrame:
    """(side, hs10, head, stays, leaf, path, v) of the codes that have a link, their names as letters."""
    sides = []
    for side, kind, head, n, v in (("a", "past", "hs6_past", *(x[0] for x in (names, values))), ("b", "now", "hs6", *(x[1] for x in (names, values)))):
        reached = met.select(F.col(head).alias("head")).distinct().withColumn("reached", F.lit(True))
        x = c.where(kind).where("hs10 is not null").select("hs10", "head", "stays").join(reached, "head", "left").where("stays or reached")
        x = x.join(n.select("hs10", columns.letters(F.col("leaf")).alias("leaf"), columns.letters(F.col("path")).alias("path")), "hs10", "left").fillna("", ["leaf", "path"])
        x = x.join(v.select("hs10", F.col("v").cast("double").alias("v")), "hs10", "left").fillna(0.0, ["v"])
        sides.append(x.select(F.lit(side).alias("side"), "hs10", "head", "stays", "leaf", "path", "v"))
    return written(sides[0].union(sides[1]), "linked")


def _near(linked: DataFrame, names: list) -> np.ndarray:
    """Similarities of each name of the first side with each of the second; names: rows (side, leaf, path, name), numbered by side."""
    spark = linked.sparkSession
    schema = "name int, leaf string, path string"
    a, b = (spark.createDataFrame([(x.name, x.leaf, x.path) for x in names if x.side == s], schema) for s in "ab")
    shape = [sum(x.side == s for x in names) for s in "ab"]
    pairs = a.toDF("i", "a", "pa").crossJoin(b.toDF("j", "b", "pb")).repartition(shape[0] * shape[1] // 20_000 + 1, "i", "j")
    found = pairs.select("i", "j", columns.similarity()("a", "b", "pa", "pb").alias("near")).toArrow()
    out = np.zeros(shape)
    out[found["i"].to_numpy(), found["j"].to_numpy()] = found["near"].to_numpy()
    return out


def _spans(x: np.ndarray, step: int = 128) -> list:
    """(rows, columns) as slices: blocks of rows with the span of columns where any of them is not zero."""
    out = []
    for r in range(0, len(x), step):
        at = np.flatnonzero(x[r : r + step].any(axis=0))
        if len(at):
            out.append((slice(r, r + step), slice(at[0], at[-1] + 1)))
    return out


LOW = -(1 << 30)  # the exponent of a sum of nothing


def _scaled(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    """x times two to the power by; what is beyond a double's range below is nothing."""
    return np.ldexp(x, np.clip(by, -4000, 4000).astype(np.int32))


class _Side:
    """One side's codes of a bucket. at, name, margin, count: classes of codes without another side, by heading and name.

    Where margins cannot be met, factors grow or fall by a power each step while masses do not, so every number has an exponent
    beside it. Sums share the greatest exponent of their heading, which those that meet the heading all see.
    """

    def __init__(self, heads, at, name, margin, count, stay_at, stay_name, stay_margin, edge_from, edge_to, others, width):
        self.cells, self.others = (heads, width), others
        self.at, self.stay_at = at, stay_at
        self.flat, self.margin, self.count = at * width + name, margin, count
        self.stay_flat, self.stay_margin = stay_at * width + stay_name, stay_margin
        order = np.argsort(edge_from, kind="stable")
        self.edge_from, self.edge_to = edge_from[order], edge_to[order]
        first = np.searchsorted(self.edge_from, np.arange(heads + 1))
        self.degree = (first[1:] - first[:-1])[at]
        self.starts = np.cumsum(self.degree) - self.degree
        self.edge = np.repeat(first[at] - self.starts, self.degree) + np.arange(self.degree.sum())
        self.reach = self.edge_to[self.edge] * width + np.repeat(name, self.degree)  # each class at each heading it is linked with
        present = np.zeros(self.cells, bool)
        present.ravel()[self.flat] = present.ravel()[self.stay_flat] = True
        self.full = _spans(present)
        present[:] = False
        present.ravel()[self.stay_flat] = True
        self.staying = _spans(present)

    def sums(self, factor, stay):
        """Sums of factors by heading and name: of all codes, and of those without another side by the headings they reach."""
        cells = self.cells[0] * self.cells[1]
        m, e = np.frexp(self.margin * factor[0])
        s, z = np.frexp(stay[0])
        e, z = e + factor[1], z + stay[1]
        alone = np.full(self.cells[0], LOW)
        np.maximum.at(alone, self.at, e)
        top = alone.copy()
        np.maximum.at(top, self.stay_at, z)
        every = np.bincount(self.flat, _scaled(m, e - top[self.at]), cells) + np.bincount(self.stay_flat, _scaled(s, z - top[self.stay_at]), cells)
        high = np.full(self.others, LOW)
        np.maximum.at(high, self.edge_to, alone[self.edge_from])
        scale = _scaled(np.ones(len(self.edge_to)), alone[self.edge_from] - high[self.edge_to])
        far = np.bincount(self.reach, np.repeat(_scaled(m, e - alone[self.at]), self.degree) * scale[self.edge], self.others * self.cells[1])
        return every.reshape(self.cells), top, far.reshape(self.others, self.cells[1]), high

    def totals(self, other, every, top, far, high, prior, own):
        """Sums over links of prior and the other ends' factors, for each class and each code that stays. prior: the other side's names by this side's."""
        met = np.zeros((len(every), self.cells[1]))
        for rows, span in other.full:
            met[rows] = every[rows, span] @ prior[span]
        best = np.full(self.cells[0], LOW)
        np.maximum.at(best, self.edge_from, top[self.edge_to])
        scale = _scaled(np.ones(len(self.edge_to)), top[self.edge_to] - best[self.edge_from])
        classes = np.add.reduceat(met.ravel()[self.reach] * scale[self.edge], self.starts) if len(self.starts) else np.zeros(0)
        new = np.zeros(self.cells)
        for rows, span in self.staying:
            new[rows, span] = far[rows] @ prior[:, span]
        e = np.maximum(high[self.stay_at], own[1])
        stay = _scaled(new.ravel()[self.stay_flat], high[self.stay_at] - e) + (1 + fitting.FLOOR) * _scaled(own[0], own[1] - e)
        return (classes, best[self.at]), (stay, e)


def _over(x, total):
    """x over totals with their exponents."""
    m, e = np.frexp(x / total[0])
    return m, e - total[1]


def _steps(a: _Side, b: _Side, prior: np.ndarray, steps: int, tolerance: float = 1e-14):
    """Factors of both sides and their totals: rows, then columns, `steps` times, or until no factor of a column changes."""
    back = np.ascontiguousarray(prior.T)
    one = lambda x: (np.ones(len(x)), np.zeros(len(x), np.int64))
    g, c = (b.count / b.margin, one(b.margin)[1]), one(b.stay_margin)  # masses begin as the prior: each code's factor is 1
    t, ts = a.totals(b, *b.sums(g, c), back, c)
    for _ in range(steps):
        f, r = _over(np.ones(len(a.margin)), t), _over(a.stay_margin, ts)
        u, us = b.totals(a, *a.sums(f, r), prior, r)
        last = g, c
        g, c = _over(np.ones(len(b.margin)), u), _over(b.stay_margin, us)
        t, ts = a.totals(b, *b.sums(g, c), back, c)
        if all((x[1] == y[1]).all() and (np.abs(x[0] - y[0]) <= tolerance * y[0]).all() for x, y in zip((g, c), last, strict=True)):
            break
    return (t, ts, r), (g, u, c, us)


_OUT = "kind int, head string, hs10 string, name int, factor double, exponent long, mass double, own double"


def _fit(near: np.ndarray, steps: int):
    def run(table):
        import pyarrow as pa
        import pyarrow.compute as pc

        prior = near**fitting.POWER + fitting.FLOOR
        edges, gone, new, stay = (table.filter(pc.equal(table["kind"], k)) for k in range(4))
        number = lambda *x: pa.chunked_array([y for z in x for y in z.chunks], pa.string()).unique().sort()
        heads = number(edges["head"], gone["head"], stay["head"]), number(edges["other"], new["head"], stay["head"])
        at = lambda x, side: pc.index_in(x, value_set=heads[side]).to_numpy().astype(np.int64)
        of = lambda t, c: t[c].to_numpy()
        names = lambda t, c="name": t[c].to_numpy().astype(np.int64)
        ends = at(edges["head"], 0), at(edges["other"], 1)
        a = _Side(len(heads[0]), at(gone["head"], 0), names(gone), of(gone, "margin"), of(gone, "n"), at(stay["head"], 0), names(stay), of(stay, "margin"), *ends, len(heads[1]), prior.shape[0])
        b = _Side(len(heads[1]), at(new["head"], 1), names(new), of(new, "margin"), of(new, "n"), at(stay["head"], 1), names(stay, "name_b"), of(stay, "margin_b"), *ends[::-1], len(heads[0]), prior.shape[1])
        (t, ts, r), (g, u, c, us) = _steps(a, b, prior, steps)
        none = lambda x: np.zeros(len(x))
        floor = 1 + fitting.FLOOR
        sides = [(gone, 1, "name", *t, none(t[0]), none(t[0])), (new, 2, "name", *g, _scaled(g[0] * u[0], g[1] + u[1]), none(g[0]))]
        sides.append((stay, 3, "name", *ts, none(ts[0]), floor * _scaled(c[0] / ts[0], c[1] - ts[1])))
        sides.append((stay, 4, "name_b", *c, _scaled(c[0] * us[0], c[1] + us[1]), floor * _scaled(r[0] * c[0], r[1] + c[1])))
        columns = ["kind", "head", "hs10", "name", "factor", "exponent", "mass", "own"]
        number = lambda v, kind: pa.chunked_array([pa.array(v).cast(kind)])
        parts = [pa.table([number(np.full(len(v), k), pa.int32()), x["head"], x["other"], x[n], number(v, pa.float64()), number(e, pa.int64()), number(m, pa.float64()), number(o, pa.float64())], names=columns) for x, k, n, v, e, m, o in sides]
        return pa.concat_tables(parts)

    return run


def fit(c: DataFrame, heads: DataFrame, names: tuple[DataFrame, DataFrame], values: tuple[DataFrame, DataFrame], steps: int = fitting.STEPS, together: int = 200_000, fewer: bool = True) -> Fitted | None:
    """Links of codes c below linked heads (as `links.licensed`), their priors by names (hs10, leaf, path), fitted to values (hs10, v).

    Connected groups of headings are fitted in a task as numbers, small ones many at a time. None: the links are fewer than the
    pairs of names (`fewer` lets that pass), or a group or the names are beyond what a task holds; then links are fitted as rows.
    """
    met, links = _met(c, heads)
    linked = _linked(c, met, names, values)
    named = linked.select("side", "leaf", "path").distinct()
    found = [named.where(F.col("side") == s).limit(NAMES + 1).collect() for s in "ab"]
    pairs = len(found[0]) * len(found[1])
    if pairs == 0 or max(map(len, found)) > NAMES or (fewer and pairs > links):
        return None
    spark = c.sparkSession
    numbered = [(s, x.leaf, x.path, i) for s, side in zip("ab", found, strict=True) for i, x in enumerate(sorted(side, key=lambda x: (x.path, x.leaf)))]
    numbers = spark.createDataFrame(numbered, "side string, leaf string, path string, name int")
    near = _near(linked, numbers.collect())

    edges = met.select(F.concat(F.lit("a"), "hs6_past").alias("a"), F.concat(F.lit("b"), "hs6").alias("b"))
    own = linked.where("stays and side = 'a'").select(F.concat(F.lit("a"), "head").alias("a"), F.concat(F.lit("b"), "head").alias("b")).distinct()
    part = written(graph.parts(edges.union(own)).select(F.substring("node", 1, 1).alias("side"), F.expr("substring(node, 2)").alias("head"), "part"), "parts")
    tot = {x.side: x for x in linked.groupBy("side").agg(F.sum("v").alias("v"), F.count("*").alias("n")).collect()}
    eps = max(tot["a"].v, 1.0) * 1e-9
    scale = (tot["a"].v + tot["a"].n * eps) / (tot["b"].v + tot["b"].n * eps)
    margin = (F.col("v") + F.lit(eps)) * F.when(F.col("side") == "b", F.lit(scale)).otherwise(F.lit(1.0))
    whole = linked.join(F.broadcast(numbers), ["side", "leaf", "path"]).join(part, ["side", "head"])
    whole = written(whole.select("side", "hs10", "head", "stays", "name", "part", margin.alias("margin")), "margins")
    greatest = whole.groupBy("part").agg(F.count("*").alias("n"), F.countDistinct("head").alias("heads")).agg(F.max("n"), F.max("heads")).first()
    if greatest[0] > CODES or greatest[1] * max(near.shape) > CELLS:
        return None
    buckets = int((tot["a"].n + tot["b"].n) // together) + 1
    bucket = F.pmod(F.xxhash64("part"), F.lit(buckets)).cast("int").alias("bucket")
    null = lambda kind, name: F.lit(None).cast(kind).alias(name)
    rows = [met.select(F.lit("a").alias("side"), F.col("hs6_past").alias("head"), F.col("hs6").alias("other")).join(part, ["side", "head"]).select(
        bucket, F.lit(0).alias("kind"), "head", "other", null("int", "name"), null("double", "margin"), null("long", "n"), null("int", "name_b"), null("double", "margin_b"))]
    classes = whole.where("not stays").groupBy("side", "head", "part", "name").agg(F.sum("margin").alias("margin"), F.count("*").alias("n"))
    rows.append(classes.select(bucket, F.expr("if(side = 'a', 1, 2)").alias("kind"), "head", null("string", "other"), "name", "margin", "n", null("int", "name_b"), null("double", "margin_b")))
    side = lambda s: whole.where("stays").where(F.col("side") == s)
    both = side("a").join(side("b").select("hs10", F.col("name").alias("name_b"), F.col("margin").alias("margin_b")), "hs10")
    rows.append(both.select(bucket, F.lit(3).alias("kind"), "head", F.col("hs10").alias("other"), "name", "margin", null("long", "n"), "name_b", "margin_b"))
    out = rows[0].union(rows[1]).union(rows[2]).groupBy("bucket").applyInArrow(_fit(near, steps), _OUT)
    out = written(out, "factors")

    side = lambda a: F.expr(f"if(kind = {a}, 'a', 'b')").alias("side")
    margin = F.when(F.col("side") == "b", F.col("margin")).otherwise(F.lit(1.0))
    kinds = out.where("kind < 3").select(side(1), "head", "name", "factor", "exponent", "mass", "own")
    alone = whole.where("not stays").join(kinds, ["side", "head", "name"]).select("side", "hs10", "head", "stays", "name", (margin * F.col("factor")).alias("factor"), "exponent", (margin * F.col("mass")).alias("mass"), "own")
    stay = out.where("kind > 2").select(side(3), "hs10", "head", F.lit(True).alias("stays"), "name", "factor", "exponent", "mass", "own")
    return Fitted(written(alone.union(stay), "fitted"), met, near, links)


def targets(x: Fitted) -> DataFrame:
    """(hs_to, mass, n_links): what links bring to each code, and how many they are."""
    n = x.met.groupBy(F.col("hs6").alias("head")).agg(F.sum("past").alias("past"), F.sum("gone").alias("gone"))
    b = x.codes.where("side = 'b'").join(n, "head", "left")
    links = F.when(F.col("stays"), 1 + F.coalesce("gone", F.lit(0))).otherwise(F.coalesce("past", F.lit(0)))
    return b.select(F.col("hs10").alias("hs_to"), "mass", links.alias("n_links"))


def retention(x: Fitted) -> DataFrame:
    """(retention, n_sources): the share of masses that stays on its code."""
    b = F.col("side") == "b"
    return x.codes.agg((F.sum(F.when(b, F.col("own"))) / F.sum(F.when(b, F.col("mass")))).alias("retention"), F.count_if(F.col("side") == "a").alias("n_sources"))


def _shares(near: np.ndarray, cells: int = 1_000_000):
    """Links of a task's sources (kind 2) with targets (kind 1) below linked headings (kind 0), which come first."""

    def run(batches):
        import pyarrow as pa

        prior = near**fitting.POWER + fitting.FLOOR
        score = np.maximum(prior - fitting.FLOOR, 0) ** (1 / fitting.POWER)
        out = pa.schema([("hs_from", pa.string()), ("hs_to", pa.string()), ("weight", pa.float64()), ("score", pa.float64()), ("relation", pa.string())])
        kept, ready = ([], []), None

        def found(source, target, share, total, near, moved):
            weight = share / total
            return pa.RecordBatch.from_arrays([source, target, pa.array(weight), pa.array(near), pa.array(["moved" if moved else "identity"]).take(pa.array(np.zeros(len(weight), np.int32)))], schema=out)

        def index():
            edges, targets = (pa.Table.from_batches(x).combine_chunks() if x else None for x in kept)
            if targets is None or edges is None:
                return {}, None, None, None, None
            once = np.unique(np.array(targets["hs10"].to_pylist()), return_index=True)[1]  # a task may hold several blocks
            targets = targets.take(pa.array(once)).combine_chunks()
            head = targets["head"].to_pylist()
            stays = targets["stays"].to_numpy(zero_copy_only=False)
            order = np.lexsort((~stays, np.array(head)))
            targets, head, stays = targets.take(pa.array(order)), np.array(head)[order], stays[order]
            first = np.flatnonzero(np.r_[True, head[1:] != head[:-1]])
            after = np.r_[first[1:], len(head)]
            where = {h: (a, b - int((~stays[a:b]).sum()), b) for h, a, b in zip(head[first].tolist(), first.tolist(), after.tolist(), strict=True)}
            near_to = {}
            for h, o in zip(edges["head"].to_pylist(), edges["other"].to_pylist(), strict=True):
                if o in where:
                    near_to.setdefault(h, []).append(where[o])
            return near_to, targets["hs10"].combine_chunks(), targets["name"].to_numpy(), targets["factor"].to_numpy(), targets["exponent"].to_numpy()

        def sources(t, head):
            near_to, codes, names, factor, power = ready
            reach = near_to.get(head, [])
            stays = t["stays"].to_numpy(zero_copy_only=False)
            for staying in (False, True):
                rows = np.flatnonzero(stays == staying)
                to = np.concatenate([np.arange(m if staying else a, b) for a, m, b in reach]) if reach else np.zeros(0, np.int64)
                high = power[to].max() if len(to) else LOW
                value_to = _scaled(factor[to], power[to] - high) if len(to) else np.zeros(0)
                step = max(1, cells // max(1, len(to)))
                for r in range(0, len(rows), step):
                    at = rows[r : r + step]
                    name, over = t["name"].to_numpy()[at], _scaled(1 / t["factor"].to_numpy()[at], high - t["exponent"].to_numpy()[at])
                    share = np.zeros((len(at), 0)) if not len(to) else prior[name[:, None], names[to][None, :]] * value_to[None, :] * over[:, None]
                    i, j = np.nonzero(share > fitting.LEAST_SHARE)
                    value = share[i, j]
                    every = np.bincount(i, value, len(at))
                    if staying:
                        own = t["own"].to_numpy()[at].copy()
                        own[own <= fitting.LEAST_SHARE] = 0
                        every = every + own
                        some = np.flatnonzero(own)
                        code = t["hs10"].take(pa.array(at[some]))
                        yield found(code, code, own[some], every[some], np.ones(len(some)), False)
                    if len(i):
                        yield found(t["hs10"].take(pa.array(at[i])), codes.take(pa.array(to[j])), value, every[i], score[name[i], names[to[j]]], True)

        for batch in batches:
            kind = batch["kind"].to_numpy()
            for k in (0, 1):
                if (kind == k).any():
                    kept[k].append(batch.filter(pa.array(kind == k)))
            rest = batch.filter(pa.array(kind == 2))
            if not rest.num_rows:
                continue
            if ready is None:
                ready = index()
                kept[0].clear(), kept[1].clear()
            head = np.array(rest["head"].to_pylist())
            first = np.flatnonzero(np.r_[True, head[1:] != head[:-1]])
            for a, b in zip(first, np.r_[first[1:], len(head)], strict=True):
                yield from sources(rest.slice(int(a), int(b - a)), str(head[a]))

    return run


def weights(x: Fitted) -> DataFrame:
    """(hs_from, hs_to, weight, score, relation) as `fitting.weights`: links are made by source, all of a source's in one task.

    Headings of sources are dealt over tasks of about LINKS links; each gets the targets below the headings they are linked with.
    """
    blocks = int(x.links // LINKS) + 1
    block = lambda head: F.pmod(F.xxhash64(head), F.lit(blocks)).cast("int").alias("block")
    null = lambda kind, name: F.lit(None).cast(kind).alias(name)
    edges = x.met.select(block("hs6_past"), F.lit(0).alias("kind"), F.col("hs6_past").alias("head"), F.col("hs6").alias("other"), null("string", "hs10"), null("boolean", "stays"), null("int", "name"), null("double", "factor"), null("long", "exponent"), null("double", "own"))
    rest = ["hs10", "stays", "name", "factor", "exponent", "own"]
    asked = x.met.select(block("hs6_past"), F.col("hs6").alias("head")).distinct()
    to = x.codes.where("side = 'b'").join(asked, "head").select("block", F.lit(1).alias("kind"), "head", null("string", "other"), *rest)
    of = x.codes.where("side = 'a'").select(block("head"), F.lit(2).alias("kind"), "head", null("string", "other"), *rest)
    rows = edges.union(to).union(of).repartition(blocks, "block").sortWithinPartitions("kind", "head")
    return rows.mapInArrow(_shares(x.near), "hs_from string, hs_to string, weight double, score double, relation string")
