"""Time-range window aggregates that stay bounded under skew.

``range_aggregate`` computes, for every (keys, second) present in the input,
aggregates over the rows of the same key whose second lies in

* a trailing frame ``[s - D, s]`` (inclusive: same-second peers are in it), and/or
* a leading frame ``[s + 1, s + H]`` (strictly later seconds).

These are the RANGE frames ``rangeBetween(-D, 0)`` / ``rangeBetween(1, H)`` over
whole seconds. A direct RANGE window re-aggregates its sliding frame for every
row (quadratic in a dense key) and puts a whole key in one task. This form
avoids both:

1. rows are pre-aggregated to one row per (key, second) with a map-side partial
   aggregate, so a hot key or a hot second never reaches one task as raw rows;
2. seconds are cut into blocks of ``B`` seconds (no longer than D and H). A frame
   is a suffix of one block + whole blocks in between + a prefix of another block.
   Where B doesn't divide a frame, the number of blocks in between depends on
   the place in the block; both numbers are kept;
3. prefixes and suffixes are running aggregates (growing frames, linear) in
   window partitions of one (key, block), which hold at most ``B`` rows. One pass in
   ascending and one in descending order compute them all, so a task sorts its rows
   twice; the tasks grow in number with the distinct seconds, not in size;
4. whole-block aggregates come from a per-(key, block) table and a window over
   it whose partitions hold one row per block (days of history, not events);
5. the parts are merged per (key, second) with a plain ``groupBy``.

The standard deviation is carried as (n, mean, M2), M2 being the sum of squared
distances from the mean, all in doubles; the mean is compensated, a second double
holding what the first rounds away. No difference of large sums is ever taken:
partials are merged about a mean of their own, running parts add up the positive
contributions ``n_a * n_b / (n_a + n_b) * (mean_b - mean_a) ** 2`` of one second
after the other, and parts of a frame are merged pairwise by the same formula.

Callers join the result back to their rows on (key, second).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quakeframe.session import materialize as materialize_table

DAY = 86400

_KINDS = ("count", "sum", "avg", "max", "min", "stddev")


@dataclass(frozen=True)
class Agg:
    """One frame aggregate: ``kind`` of ``column`` written to ``name``.

    kind is count (non-NULL values), sum, avg, max, min or stddev (sample).
    """

    name: str
    kind: str
    column: str

    def __post_init__(self):
        if self.kind not in _KINDS:
            raise ValueError(f"unknown aggregate kind {self.kind!r}")


# A partial is (op, column); op in count | sum | mean | lo | m2 | max | min.
def _partials(agg: Agg) -> list[tuple[str, str]]:
    c = agg.column
    return {
        "count": [("count", c)],
        "sum": [("count", c), ("sum", c)],
        "avg": [("count", c), ("sum", c)],
        "max": [("max", c)],
        "min": [("min", c)],
        "stddev": [("count", c), *[(op, c) for op in MOMENTS]],
    }[agg.kind]


#: What a standard deviation needs beside the count; merged apart from the others.
MOMENTS = ("mean", "lo", "m2")


def _merge_op(op: str) -> str:
    return op if op in ("max", "min") else "sum"


def _pname(op: str, col: str) -> str:
    return "__" + op + "__" + "".join(ch if ch.isalnum() or ch == "_" else "_" for ch in col)


def partial_name(op: str, col: str) -> str:
    """Column of a partial aggregate in a table of ``partial_columns``."""
    return _pname(op, col)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# Expressions are written as SQL text: one JVM call per expression instead of
# one per sub-expression keeps driver-side plan building cheap.
def _raw_partial(op: str, col: str) -> str:
    c = _q(col)
    return {
        "count": f"count({c})",
        "sum": f"sum(CAST({c} AS DOUBLE))",
        "mean": f"avg(CAST({c} AS DOUBLE))",
        "lo": "0D",
        "m2": f"var_pop(CAST({c} AS DOUBLE)) * count({c})",
        "max": f"max({c})",
        "min": f"min({c})",
    }[op]


def _agg_of(op: str, c: str) -> str:
    return f"{_merge_op(op)}({c})"


def _combine(op: str, a: str, b: str) -> str:
    """Merge two partial values; NULL means 'no contribution'."""
    if _merge_op(op) == "sum":
        return f"(coalesce({a}, 0) + coalesce({b}, 0))"
    return f"{'greatest' if _merge_op(op) == 'max' else 'least'}({a}, {b})"


def _finish(agg: Agg, prefix: str) -> str:
    def p(op):
        return prefix + _pname(op, agg.column)

    out = _q(agg.name)
    if agg.kind == "count":
        return f"CAST(coalesce({p('count')}, 0) AS BIGINT) AS {out}"
    if agg.kind in ("max", "min"):
        return f"{p(agg.kind)} AS {out}"
    n = p("count")
    if agg.kind == "sum":
        return f"CASE WHEN {n} > 0 THEN {p('sum')} END AS {out}"
    if agg.kind == "avg":
        return f"CASE WHEN {n} > 0 THEN {p('sum')} / {n} END AS {out}"
    parts = ", ".join(_moment_struct(*[prefix + str(i) + _pname(op, agg.column) for op in ("count", *MOMENTS)]) for i in range(3))
    return f"{_std(_fold(f'array({parts})'))} AS {out}"


def _moment_struct(n: str, mean: str, lo: str, m2: str) -> str:
    return f"named_struct('n', CAST(coalesce({n}, 0) AS DOUBLE), 'a', {mean}, 'l', {lo}, 'q', {m2})"


def _fold(parts: str) -> str:
    """(n, a, l, q) of an array of such parts, merged pairwise; parts with n = 0 are none."""
    away = "((y.a - x.a) + (y.l - x.l))"
    step = f"(x.l + {away} * y.n / (x.n + y.n))"
    return (
        f"aggregate({parts}, named_struct('n', 0D, 'a', 0D, 'l', 0D, 'q', 0D), (x, y) -> CASE WHEN y.n > 0 AND x.n > 0 THEN named_struct("
        f"'n', x.n + y.n, 'a', x.a + {step}, 'l', {_rest('x.a', step)}, "
        f"'q', x.q + y.q + {away} * {away} * x.n * y.n / (x.n + y.n)) WHEN y.n > 0 THEN y ELSE x END)"
    )


def _rest(a: str, b: str) -> str:
    """What ``a + b`` rounds away, for ``b`` smaller than ``a``."""
    return f"{b} - (({a} + {b}) - {a})"


def _std(moments: str) -> str:
    return f"transform(array({moments}), m -> CASE WHEN m.n > 1 THEN sqrt(m.q / (m.n - 1)) END)[0]"


def _about(col: str) -> str:
    """Column that holds a value near the means to be merged."""
    return "__r" + _pname("mean", col)


def _distance(col: str) -> str:
    """A partial's mean from ``_about``."""
    return f"(({_pname('mean', col)} - {_about(col)}) + {_pname('lo', col)})"


def _merge_columns(needed: list[tuple[str, str]]) -> list[Column]:
    """Aggregates that merge rows of partials; (mean, m2) about ``_about``."""
    out = []
    for op, c in needed:
        name = _pname(op, c)
        if op not in MOMENTS:
            out.append(F.expr(f"{_agg_of(op, name)} AS {name}"))
            continue
        n, r = _pname("count", c), _about(c)
        d = _distance(c)
        off = f"sum({n} * {d})"
        step = f"({off} / nullif(sum({n}), 0))"
        out.append(F.expr({
            "mean": f"max({r}) + {step} AS {name}",
            "lo": f"{_rest(f'max({r})', step)} AS {name}",
            "m2": f"greatest(sum({_pname('m2', c)} + {n} * {d} * {d}) - {off} * {step}, 0D) AS {name}",
        }[op]))
    return out


def deal(df: DataFrame, tasks: int | None, columns: list[str]) -> DataFrame:
    """``df`` clustered by ``columns`` over that many tasks, or as many as Spark picks."""
    return df.repartition(tasks, *columns) if tasks else df.repartition(*columns)


def _with_about(df: DataFrame, needed: list[tuple[str, str]], part: str) -> DataFrame:
    """``df`` with ``_about`` of every column in ``needed``: the mean of the means of
    the rows that ``part`` (a PARTITION BY list) puts together."""
    columns = [c for op, c in needed if op == "mean"]
    return df.selectExpr("*", *[f"avg({_pname('mean', c)}) OVER (PARTITION BY {part}) AS {_about(c)}" for c in columns]) if columns else df


def _needed(t_aggs, l_aggs, whole) -> list[tuple[str, str]]:
    needed: list[tuple[str, str]] = []
    for a in list(t_aggs) + list(l_aggs) + list(whole):
        for pt in _partials(a):
            if pt not in needed:
                needed.append(pt)
    return needed


def partial_columns(
    trailing: tuple[int, list[Agg]] | None = None,
    leading: tuple[int, list[Agg]] | None = None,
    whole: list[Agg] | None = None,
) -> list[Column]:
    """Partial aggregates of raw rows for ``range_aggregate(..., pre_aggregated=True)``.

    Use them in a ``groupBy`` at any grain finer than (keys, second), e.g. to
    share one grouping of the raw rows between several consumers.
    """
    needed = _needed(trailing[1] if trailing else [], leading[1] if leading else [], whole or [])
    return [F.expr(f"{_raw_partial(op, c)} AS {_pname(op, c)}") for op, c in needed]


#: Seconds of all keys that one task takes on average; a (key, block) stays whole.
SECONDS_PER_TASK = 1 << 15


def tasks_for(spark: SparkSession, rows: int, per_task: int | None = None) -> int:
    """How many tasks to deal that many rows to, of (key, second) unless ``per_task``
    says otherwise. Given as a number, as shuffled rows are mostly NULLs or much alike
    and compress too well for their size to tell how many fit a task."""
    least = max(2, min(spark.sparkContext.defaultParallelism, 1 + rows // 128))
    return max(least, -(-rows // (per_task or SECONDS_PER_TASK)))


def choose_block(*frames: int) -> int:
    """Block length for the frames: the largest (<= one day) that divides them all,
    unless a frame would then span more than 512 blocks; then one that cuts the
    longest frame into about 64 and divides none."""
    g = DAY
    for f in frames:
        g = math.gcd(g, int(f))
    if max(frames) <= 512 * g:
        return g
    return max(1, min(DAY, min(int(f) for f in frames), int(max(frames)) // 64))


def range_aggregate(
    df: DataFrame,
    keys: list[str],
    seconds: str,
    trailing: tuple[int, list[Agg]] | None = None,
    leading: tuple[int, list[Agg]] | None = None,
    block_seconds: int | None = None,
    whole: list[Agg] | None = None,
    materialize: bool = True,
    pre_aggregated: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Frame aggregates per distinct (keys, seconds) of ``df``.

    ``trailing=(D, aggs)`` gives frame ``[s-D, s]``; ``leading=(H, aggs)`` gives
    ``[s+1, s+H]``; ``whole`` aggregates cover every row of the key (an
    unbounded frame). Rows with NULL ``seconds`` are not in the output but do
    count in ``whole``. NULL keys form their own group, as in ``Window.partitionBy``.

    ``materialize=True`` writes the per-second table once to the shared folder
    (``spark.checkpoint.dir``) and reads it back, so the raw rows are aggregated
    once for its three consumers and a lost executor does not re-run that
    aggregation; the call then runs one job. With ``False`` the result stays
    lazy and Spark may recompute the per-second table per consumer.

    ``pre_aggregated=True``: ``df`` already holds the ``partial_columns`` of its
    rows, grouped at a grain at least as fine as (keys, seconds); they are
    merged instead of re-aggregating raw rows, and nothing is written (the
    caller owns that table).

    ``tasks``: how many tasks the (key, block) partitions are dealt to. Without it a
    table written here is counted for it (``tasks_for``), and else Spark decides.
    """
    if trailing is None and leading is None:
        raise ValueError("give a trailing and/or a leading frame")
    frames = [f for f, _ in (x for x in (trailing, leading) if x is not None)]
    if any(int(f) < 1 for f in frames):
        raise ValueError("frame lengths must be >= 1 second")
    B = int(block_seconds) if block_seconds else choose_block(*frames)
    if any(int(f) < B for f in frames):
        raise ValueError(f"block {B} is longer than a frame of {frames}")

    t_aggs = trailing[1] if trailing else []
    l_aggs = leading[1] if leading else []
    k, k_rest = divmod(int(trailing[0]), B) if trailing else (0, 0)
    m, m_rest = divmod(int(leading[0]), B) if leading else (0, 0)

    # Distinct partials needed by either frame.
    whole = list(whole or [])
    needed = _needed(t_aggs, l_aggs, whole)
    t_need = [pt for pt in needed if any(pt in _partials(a) for a in t_aggs)]
    l_need = [pt for pt in needed if any(pt in _partials(a) for a in l_aggs)]
    pn = {pt: _pname(*pt) for pt in needed}

    K = ", ".join(_q(x) for x in keys)
    kq = [_q(x) for x in keys]

    # 1. one row per (keys, second): map-side partial aggregation.
    block_of = "CAST(floor({} / {}) AS BIGINT) AS __b"
    if pre_aggregated:
        # Dealt by (keys, block), which serves the seconds and the blocks alike.
        dealt = deal(df.selectExpr("*", block_of.format(_q(seconds), B)), tasks, [*keys, "__b"])
        dealt = _with_about(dealt, needed, f"{K}, __b, {_q(seconds)}")
        grouped = dealt.groupBy(*keys, "__b", F.col(seconds).alias("__s")).agg(*_merge_columns(needed))
    else:
        grouped = df.groupBy(*keys, F.col(seconds).alias("__s")).agg(
            *[F.expr(f"{_raw_partial(op, c)} AS {pn[(op, c)]}") for op, c in needed]
        )
        if materialize:
            grouped = materialize_table(grouped, "per-second")
            tasks = tasks or tasks_for(df.sparkSession, grouped.count())
        grouped = grouped.selectExpr("*", block_of.format("__s", B))
    per_sec = grouped.where("__s IS NOT NULL").selectExpr("*", f"__s - __b * {B} AS __o")
    ptype = {f.name: f.dataType.simpleString() for f in per_sec.schema.fields}

    # 2. whole-block partials and the in-between blocks of each frame.
    every_block = _with_about(grouped, needed, f"{K}, __b").groupBy(*keys, "__b").agg(*_merge_columns(needed))
    blocks = every_block.where("__b IS NOT NULL")
    mid = []
    over_blk = f"PARTITION BY {K} ORDER BY __b"
    # (prefix, partials, nearest and farthest block) of the blocks in between; the
    # second of each pair is for places whose frame reaches one block further.
    between = [("__mt", t_need, -(k - 1), -1)] if trailing else []
    between += [("__mu", t_need, -k, -1)] if k_rest else []
    between += [("__ml", l_need, 1, m - 1)] if leading else []
    between += [("__mm", l_need, 1, m)] if m_rest else []
    mid_names = []
    for prefix, need, lo, hi in between:
        for op, c in need:
            n = pn[(op, c)]
            mid_names.append(prefix + n)
            if lo <= hi:
                ends = [f"{abs(x)} {'PRECEDING' if x < 0 else 'FOLLOWING'}" for x in (lo, hi)]
                if op in MOMENTS:
                    # At most some hundred blocks (``choose_block``), merged one by one.
                    each = _moment_struct(*[pn[(o, c)] for o in ("count", *MOMENTS)])
                    merged = _fold(f"collect_list({each}) OVER ({over_blk} RANGE BETWEEN {ends[0]} AND {ends[1]})")
                    mid.append(f"{merged}.{dict(mean='a', lo='l', m2='q')[op]} AS {prefix}{n}")
                    continue
                mid.append(f"{_agg_of(op, n)} OVER ({over_blk} RANGE BETWEEN {ends[0]} AND {ends[1]}) AS {prefix}{n}")
            else:
                mid.append(f"CAST(NULL AS {ptype[n]}) AS {prefix}{n}")
    middle = blocks.selectExpr(*kq, "__b", *mid).selectExpr(*kq, "__b", f"struct({', '.join(mid_names)}) AS __mid")
    mtype = middle.schema["__mid"].dataType.simpleString()

    # 3. one pass over the per-second table emits, per second: the data row
    #    (kind 0), a trailing-suffix probe in block b-k (kind 1) and a
    #    leading-prefix probe in block b+m (kind 2). One carrier row per
    #    (keys, block) brings the in-between blocks (kind 3).
    part_cols = [pn[pt] for pt in needed]

    def emit(kind: int, second: str, with_parts: bool) -> str:
        block = f"CAST(floor(({second}) / {B}) AS BIGINT)"
        fields = [f"'__kind', {kind}", f"'__b', {block}", f"'__o', ({second}) - {block} * {B}", "'__src', __s"]
        fields += [f"'{c}', " + (c if with_parts else f"CAST(NULL AS {ptype[c]})") for c in part_cols]
        return "named_struct(" + ", ".join(fields) + ")"

    emitted = [emit(0, "__s", True)]
    if trailing:
        emitted.append(emit(1, f"__s - {int(trailing[0])}", False))
    if leading:
        emitted.append(emit(2, f"__s + {int(leading[0])}", False))
    rows = per_sec.selectExpr(*kq, f"explode(array({', '.join(emitted)})) AS __e").selectExpr(
        *kq, "__e.*", f"CAST(NULL AS {mtype}) AS __mid"
    )
    carriers = middle.selectExpr(
        *kq, "3 AS __kind", "__b", "CAST(NULL AS BIGINT) AS __o", "CAST(NULL AS BIGINT) AS __src",
        *[f"CAST(NULL AS {ptype[c]}) AS {c}" for c in part_cols], "__mid",
    )
    u = deal(rows.unionByName(carriers), tasks, [*keys, "__b"])

    # 4. running parts inside one (keys, block): prefixes ascending, then suffixes
    #    descending. What one order gives is finished before the rows are sorted anew.
    part = f"PARTITION BY {K}, __b"
    orders = {"a": "ORDER BY __o ASC NULLS FIRST", "d": "ORDER BY __o DESC NULLS LAST"}
    upto, before = "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW", "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    incl, strict = ({side: f"OVER ({part} {order} {frame})" for side, order in orders.items()} for frame in (upto, before))
    t_moments = [c for op, c in t_need if op == "mean"]
    l_moments = [c for op, c in l_need if op == "mean"]
    both = sorted({*t_moments, *l_moments})
    plain_t, plain_l = ([(op, c) for op, c in need if op not in MOMENTS] for need in (t_need, l_need))
    # The first sort serves the windows without an order as well.
    u = u.sortWithinPartitions(*[F.asc_nulls_first(_q(c)) for c in keys], "__b", F.asc_nulls_first("__o"))
    u = _with_about(u, needed, f"{K}, __b").withColumn("__mid", F.expr(f"first(__mid, true) OVER ({part})"))

    def running_sums(u: DataFrame, side: str, ends: dict[str, str], others: list[str]) -> DataFrame:
        """``u`` with the running (n, sum of distances, M2) of every moment column
        for each of ``ends`` (suffix: window), and ``others``, windows of one order."""
        names = [dict(n=pn[("count", c)], m2=pn[("m2", c)], d=_distance(c), c=_pname("x", c)) for c in both]
        n, d = "coalesce({n}, 0)", "{n} * {d}"
        # What a second adds to M2 of all before it.
        u = u.selectExpr("*", *[f"sum({n.format(**x)}) {strict[side]} AS __n{side}{x['c']}" for x in names], *[f"sum({d.format(**x)}) {strict[side]} AS __s{side}{x['c']}" for x in names])
        adds = []
        for x in names:
            n0, s0 = f"__n{side}{x['c']}", f"__s{side}{x['c']}"
            away = f"({x['d']} - {s0} / {n0})"
            adds.append(f"{x['m2']} + CASE WHEN {n0} > 0 THEN {n0} * {x['n']} / ({n0} + {x['n']}) * {away} * {away} ELSE 0D END AS __q{side}{x['c']}")
        return u.selectExpr("*", *adds).selectExpr("*", *[
            f"sum({e}) {over} AS __{k}{side}{end}{x['c']}"
            for end, over in ends.items() for x in names
            for k, e in (("n", x["n"]), ("s", d.format(**x)), ("q", f"__q{side}{x['c']}"))
        ], *others)

    def running(op: str, c: str, end: str) -> str:
        x, r = _pname("x", c), _about(c)
        total = f"__n{end}{x}"
        step = f"(__s{end}{x} / nullif({total}, 0))"
        return {"count": total, "mean": f"{r} + {step}", "lo": _rest(r, step), "m2": f"__q{end}{x}"}[op]

    def inner(prefix: str, further: str, rest: str | None, n: str) -> str:
        """The blocks in between; ``rest`` tells the places that have one fewer."""
        return f"CASE WHEN {rest} THEN __mid.{prefix}{n} ELSE __mid.{further}{n} END" if rest else f"__mid.{prefix}{n}"

    t_inner = ("__mt", "__mu", f"__o >= {k_rest}" if k_rest else None)
    l_inner = ("__ml", "__mm", f"__o < {B - m_rest}" if m_rest else None)
    # Moments keep a frame's three parts apart: the row's own block (0), the blocks
    # in between (1), the far block (2).
    moments = [(op, c) for c in t_moments for op in ("count", *MOMENTS)], [(op, c) for c in l_moments for op in ("count", *MOMENTS)]
    split = [f"{frame}{i}{pn[pt]}" for frame, pts in zip(("__t", "__l"), moments) for pt in pts for i in range(3)]

    plain = dict.fromkeys(plain_t + plain_l)
    u = running_sums(u, "a", {"i": incl["a"]}, [f"{_agg_of(op, pn[(op, c)])} {incl['a']} AS __a{pn[(op, c)]}" for op, c in plain])
    kept = [*kq, "__src", "__kind", "__b", "__o", *dict.fromkeys(pn[pt] for pt in t_need + l_need), *[_about(c) for c in both]]
    for op, c in plain_t:
        n = pn[(op, c)]
        kept.append(f"CASE WHEN __kind = 0 THEN {_combine(op, f'__a{n}', inner(*t_inner, n))} END AS __t{n}")
    for op, c in plain_l:
        n = pn[(op, c)]
        kept.append(f"CASE WHEN __kind = 0 THEN {inner(*l_inner, n)} WHEN __kind = 2 THEN __a{n} END AS __l{n}")
    for op, c in moments[0]:
        n = pn[(op, c)]
        kept.append(f"CASE WHEN __kind = 0 THEN {running(op, c, 'ai')} END AS __t0{n}")
        kept.append(f"CASE WHEN __kind = 0 THEN {inner(*t_inner, n)} END AS __t1{n}")
    for op, c in moments[1]:
        n = pn[(op, c)]
        kept.append(f"CASE WHEN __kind = 0 THEN {inner(*l_inner, n)} END AS __l1{n}")
        kept.append(f"CASE WHEN __kind = 2 THEN {running(op, c, 'ai')} END AS __l2{n}")

    u = running_sums(u.selectExpr(*kept), "d", {"i": incl["d"], "e": strict["d"]}, [
        *[f"{_agg_of(op, pn[(op, c)])} {incl['d']} AS __f{pn[(op, c)]}" for op, c in plain_t],
        *[f"{_agg_of(op, pn[(op, c)])} {strict['d']} AS __g{pn[(op, c)]}" for op, c in plain_l],
    ])
    sel = [*kq, "__src", "__kind"]
    for op, c in plain_t:
        n = pn[(op, c)]
        sel.append(f"CASE WHEN __kind = 1 THEN __f{n} ELSE __t{n} END AS __t{n}")
    for op, c in plain_l:
        n = pn[(op, c)]
        sel.append(f"CASE WHEN __kind = 0 THEN {_combine(op, f'__g{n}', f'__l{n}')} ELSE __l{n} END AS __l{n}")
    for op, c in moments[0]:
        n = pn[(op, c)]
        sel += [f"__t0{n}", f"__t1{n}", f"CASE WHEN __kind = 1 THEN {running(op, c, 'di')} END AS __t2{n}"]
    for op, c in moments[1]:
        n = pn[(op, c)]
        sel += [f"CASE WHEN __kind = 0 THEN {running(op, c, 'de')} END AS __l0{n}", f"__l1{n}", f"__l2{n}"]
    parts = u.selectExpr(*sel).where("__kind != 3")

    # 5. merge the parts of each (keys, second).
    merged = parts.groupBy(*keys, "__src").agg(
        *[F.expr(f"{_agg_of(op, '__t' + pn[(op, c)])} AS __t{pn[(op, c)]}") for op, c in plain_t],
        *[F.expr(f"{_agg_of(op, '__l' + pn[(op, c)])} AS __l{pn[(op, c)]}") for op, c in plain_l],
        *[F.expr(f"max({n}) AS {n}") for n in split],
    )
    out = [*kq, f"__src AS {_q(seconds)}"]
    out += [_finish(a, "__t") for a in t_aggs]
    out += [_finish(a, "__l") for a in l_aggs]
    result = merged.selectExpr(*out)
    if whole:
        # One row per key, bounded by the number of keys (AQE broadcasts it
        # when its measured size is small, else a shuffle join).
        merges = []
        for op, c in needed:
            n = pn[(op, c)]
            if op not in MOMENTS:
                merges.append(F.expr(f"{_agg_of(op, n)} AS __w{n}"))
        for a in whole:
            if a.kind == "stddev":
                # One part per block of the key.
                each = _moment_struct(*[pn[(o, a.column)] for o in ("count", *MOMENTS)])
                merges.append(F.expr(f"{_fold(f'collect_list({each})')} AS __z{_pname('x', a.column)}"))
        per_key = every_block.groupBy(*keys).agg(*merges)
        per_key = per_key.selectExpr(*[f"{_q(x)} AS {_q('__k_' + x)}" for x in keys], *[f"{_std('__z' + _pname('x', a.column))} AS {_q(a.name)}" if a.kind == "stddev" else _finish(a, "__w") for a in whole])
        cond = [result[x].eqNullSafe(per_key["__k_" + x]) for x in keys]
        result = result.join(per_key, on=cond, how="left").drop(*["__k_" + x for x in keys])
    return result


def range_aggregate_direct(
    df: DataFrame,
    keys: list[str],
    seconds: str,
    trailing: tuple[int, list[Agg]] | None = None,
    leading: tuple[int, list[Agg]] | None = None,
) -> DataFrame:
    """Same result as ``range_aggregate`` from plain RANGE windows over the rows.

    Simple and quadratic in a dense key; kept as the reference form for tests
    and small inputs.
    """
    fns = {
        "count": F.count,
        "sum": F.sum,
        "avg": F.avg,
        "max": F.max,
        "min": F.min,
        "stddev": F.stddev_samp,
    }
    base = Window.partitionBy(*keys).orderBy(F.col(seconds))
    cols = []
    if trailing:
        w = base.rangeBetween(-int(trailing[0]), 0)
        cols += [fns[a.kind](a.column).over(w).alias(a.name) for a in trailing[1]]
    if leading:
        w = base.rangeBetween(1, int(leading[0]))
        cols += [fns[a.kind](a.column).over(w).alias(a.name) for a in leading[1]]
    rows = df.where(F.col(seconds).isNotNull()).select(*keys, seconds, *cols)
    return rows.dropDuplicates([*keys, seconds])
