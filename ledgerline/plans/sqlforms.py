"""SQL text for checking results with another engine. Nothing here is used to compute them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def portable(df: DataFrame) -> DataFrame:
    """Dates as text and decimals as doubles, so that two engines' results compare by value."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        out.append(c.alias(field.name))
    return df.select(*out)


def retyped(sql: str, text: Sequence[str] = (), double: Sequence[str] = (), bigint: Sequence[str] = ()) -> str:
    """Wrap a query so that the named columns come out as text, double or bigint."""
    casts = [
        f"cast({c} as {t}) as {c}"
        for names, t in ((text, "varchar"), (double, "double"), (bigint, "bigint"))
        for c in names
    ]
    return f"select * replace ({', '.join(casts)}) from ({sql}) q" if casts else sql


def title_sql(x: str) -> str:
    """Title case of ASCII text: upper-case the first character of each run of letters and digits."""
    runs = f"regexp_extract_all(lower(trim({x})), '[a-z0-9]+|[^a-z0-9]+')"
    return f"array_to_string(list_transform({runs}, lambda t: upper(t[1]) || t[2:]), '')"


def week_sql(d: str) -> str:
    return f"cast((dayofyear({d}) - 1) // 7 + 1 as int)"


def code_sql(d: str) -> str:
    return f"cast(year({d}) * 100 + (dayofyear({d}) - 1) // 7 + 1 as int)"


def dominant_sql(cleaned: str, values: Sequence[str]) -> str:
    """Most frequent values per k and d of ``cleaned`` (a query with k, d and the value columns)."""
    cols = ", ".join(values)
    order = ", ".join(f"{v} asc nulls last" for v in values)
    return (
        f"select k, d, {cols} from (select k, d, {cols}, count(*) as n from ({cleaned}) c"
        f" where k is not null and d is not null group by k, d, {cols}) g"
        f" qualify row_number() over (partition by k, d order by n desc, {order}) = 1"
    )


def history_sql(daily: str, name: str = "h") -> str:
    """CTEs ending in ``<name>``: intervals of ``daily`` (query with k, d, v, u), by joining both histories."""
    n = name
    by_day = "partition by s, k order by d"
    by_start = "partition by s, k order by lo"
    return f"""
    {n}_daily as materialized ({daily}),
    {n}_both as (select *, 'Y' as s from {n}_daily union all select *, 'N' as s from {n}_daily where u),
    {n}_prev as (select *, lag(d) over ({by_day}) as pd, lag(v) over ({by_day}) as pv from {n}_both),
    {n}_runs as (select *, sum(case when pd is null or coalesce(pv, '') <> coalesce(v, '') then 1 else 0 end)
        over ({by_day} rows between unbounded preceding and current row) as r from {n}_prev),
    {n}_spans as (select s, k, r, v, min(d) as lo, max(d) as hi from {n}_runs group by s, k, r, v),
    {n}_dated as (select *, case when lag(hi) over ({by_start}) is null then date '0001-01-01' else lo end as f,
        coalesce(lead(lo) over ({by_start}) - 1, date '2999-12-31') as t from {n}_spans),
    {n} as materialized (select y.k, m.v as value, y.f as start_dt, y.lo as orig_start_dt, y.t as end_dt, y.v as orig_value
        from {n}_dated y left join {n}_dated m on m.s = 'N' and m.k = y.k and y.f <= m.t and y.t >= m.f
        where y.s = 'Y')"""


def dimension_sql(history: str) -> str:
    """The first state of a dimension from the CTE ``history``."""
    return (
        "select k, value, start_dt as start_date, end_dt as end_date, orig_value,"
        f" case when end_dt = date '2999-12-31' then 'Y' else 'N' end as current_record from {history}"
    )


def merge_sql(old: str, fresh: str, name: str = "m") -> str:
    """CTEs ending in ``<name>``: delete, close and insert, step by step."""
    n = name
    return f"""
    {n}_first as (select k, min(orig_start_dt) as f from {fresh} group by k),
    {n}_kept as (select o.* from {old} o where not exists
        (select 1 from {fresh} x where x.k = o.k and x.orig_start_dt <= o.start_date)),
    {n}_last as (select k, max(start_date) as l from {n}_kept group by k),
    {n}_closed as (select o.k, o.value, o.start_date,
        case when f.k is not null and o.start_date = l.l then f.f - 1 else o.end_date end as end_date,
        o.orig_value,
        case when f.k is not null and o.start_date = l.l then 'N' else o.current_record end as current_record
        from {n}_kept o join {n}_last l on l.k = o.k left join {n}_first f on f.k = o.k),
    {n}_ends as (select k, max(end_date) as e from {n}_closed group by k),
    {n} as (select * from {n}_closed union all
        select x.k, x.value, case when e.e + 1 = x.orig_start_dt then x.orig_start_dt else x.start_dt end,
        x.end_dt, x.orig_value, case when x.end_dt = date '2999-12-31' then 'Y' else 'N' end
        from {fresh} x left join {n}_ends e on e.k = x.k)"""


# --- local regression and seasonal decomposition as moment sums -----------------------------------


def local_fit_sql(name: str, points: str, source: str, span: str, degree: int) -> str:
    """CTE ``name`` (g, pt, v): the local fit of ``source`` (g, n, i, y) at ``points`` (g, pt), i from 1 to n.

    A fit needs only the sums of the weights and of their products with place and value, so it is a join of each point with
    its neighbours and one aggregation. ``span`` is in terms of n; places are counted from the point, which keeps the sums small.
    """
    line = "sy / sw" if not degree else (
        "case when sqrt(greatest(sxx / sw - (sx / sw) * (sx / sw), 0)) > 0.001 * (n - 1)"
        " then sy / sw - (sx / sw) / (sxx / sw - (sx / sw) * (sx / sw)) * (sxy / sw - (sx / sw) * (sy / sw)) else sy / sw end"
    )
    return f"""
    {name}_near as (select p.g, p.pt, m.n, {span} as span, least({span}, m.n) as width from ({points}) p
        join (select distinct g, n from {source}) m using (g)),
    {name}_edge as (select *, greatest(least(pt - (width + 1) // 2 + 1, n - width + 1), 1) as a from {name}_near),
    {name}_reach as (select *, greatest(pt - a, a + width - 1 - pt) + greatest(span - n, 0) // 2 as h from {name}_edge),
    {name}_pairs as (select r.g, r.pt, r.n, s.i - r.pt as x, s.y, case when abs(s.i - r.pt) > 0.999 * h then 0.0
        when abs(s.i - r.pt) <= 0.001 * h then 1.0 else pow(1 - pow(abs(s.i - r.pt) / h::double, 3), 3) end as w
        from {name}_reach r join {source} s on s.g = r.g and s.i between r.a and r.a + r.width - 1),
    {name}_sums as (select g, pt, n, sum(w) as sw, sum(w * x) as sx, sum(w * x * x) as sxx, sum(w * y) as sy, sum(w * x * y) as sxy
        from {name}_pairs group by g, pt, n),
    {name} as materialized (select g, pt, {line} as v from {name}_sums)"""


def smooth_sql(name: str, source: str, span: str, degree: int, jump: int) -> str:
    """CTE ``name`` (g, i, v): local fits at every ``jump``-th place and the last of ``source`` (g, n, i, y), lines between."""
    points = f"select g, i as pt from {source} where (i - 1) % {jump} = 0 or i = n"
    return f"""{local_fit_sql(f"{name}_fit", points, source, span, degree)},
    {name} as materialized (select s.g, s.i, a.v + case when b.pt > a.pt then (s.i - a.pt) / (b.pt - a.pt)::double * (b.v - a.v) else 0 end as v
        from (select g, i, 1 + (i - 1) // {jump} * {jump} as lo, least(1 + (i - 1) // {jump} * {jump} + {jump}, n) as hi from {source}) s
        join {name}_fit a on a.g = s.g and a.pt = s.lo join {name}_fit b on b.g = s.g and b.pt = s.hi)"""


def decomposed_sql(weekly: str, period: int = 52) -> str:
    """CTEs ending in ``parts`` (g, w, actual, seasonal, trend, remainder, error) of ``weekly`` (g, w, y).

    The periodic decomposition with two rounds: seasonal subseries, moving averages of the cycle, smoothed trend. A series of
    no more than two periods has error 1 and zero components.
    """
    trend_span = period * 3 // 2 + 1 + (period * 3 // 2) % 2
    low_span = period + 1 - period % 2
    parts = [f"""dated as materialized (select g, w, y, row_number() over (partition by g order by w) as i, count(*) over (partition by g) as n from ({weekly})),
    series as materialized (select * from dated where n > {2 * period}),
    trend0 as (select g, i, 0.0::double as v from series)"""]  # fmt: skip
    for r in (1, 2):
        parts.append(f"""
    sub{r} as materialized (select s.g || ':' || ((s.i - 1) % {period})::varchar as g, s.g as own, s.n as whole, (s.i - 1) % {period} as phase, (s.i - 1) // {period} + 1 as i,
        s.y - t.v as y, count(*) over (partition by s.g, (s.i - 1) % {period}) as n from series s join trend{r - 1} t using (g, i)),
    wide{r} as materialized (select g, own, phase, n, whole, i, y, 10 * whole + 1 as span from sub{r}),
    ends{r} as materialized (select distinct g, own, phase, n, unnest([0, 1, n, n + 1]) as pt from wide{r}),
    fitted{r} as materialized (select own, phase, n, pt, sum(w * y) / sum(w) as v from (
        select own, phase, n, pt, y, case when x > 0.999 * h then 0.0 when x <= 0.001 * h then 1.0 else pow(1 - pow(x / h::double, 3), 3) end as w
        from (select e.*, s.y, abs(s.i - e.pt) as x, greatest(e.pt - 1, e.n - e.pt) + (s.span - e.n) // 2 as h from ends{r} e join wide{r} s using (g))
        ) group by own, phase, n, pt),
    corners{r} as materialized (select own, phase, n, max(v) filter (pt = 0) as v0, max(v) filter (pt = 1) as v1, max(v) filter (pt = n) as vn,
        max(v) filter (pt = n + 1) as vz from fitted{r} group by own, phase, n),
    cycle{r} as materialized (select own as g, phase + {period} * m as c, case when m = 0 then v0 when m = n + 1 then vz
        else v1 + (m - 1) / (n - 1)::double * (vn - v1) end as v from (select *, unnest(range(0, n + 2)) as m from corners{r})),
    one{r} as (select g, c, avg(v) over (partition by g order by c rows between current row and {period - 1} following) as v,
        count(*) over (partition by g order by c rows between current row and {period - 1} following) as k from cycle{r}),
    two{r} as (select g, c, avg(v) over (partition by g order by c rows between current row and {period - 1} following) as v,
        count(*) over (partition by g order by c rows between current row and {period - 1} following) as k from one{r} where k = {period}),
    three{r} as (select g, c, avg(v) over (partition by g order by c rows between current row and 2 following) as v,
        count(*) over (partition by g order by c rows between current row and 2 following) as k from two{r} where k = {period}),
    low{r} as materialized (select g, c + 1 as i, v as y, count(*) over (partition by g) as n from three{r} where k = 3),
    {smooth_sql(f"pass{r}", f"low{r}", str(low_span), 1, -(-low_span // 10))},
    season{r} as materialized (select s.g, s.i, s.n, s.y, c.v - p.v as v from series s join cycle{r} c on c.g = s.g and c.c = {period} + s.i - 1
        join pass{r} p on p.g = s.g and p.i = s.i),
    rest{r} as materialized (select g, i, n, y - v as y from season{r}),
    {smooth_sql(f"trend{r}", f"rest{r}", str(trend_span), 1, -(-trend_span // 10))}""")
    parts.append(f"""
    parts as materialized (select d.g, d.w, d.y as actual, coalesce(x.s, 0) as seasonal, coalesce(x.t, 0) as trend,
        coalesce(d.y - x.s - x.t, 0) as remainder, case when x.g is null then 1 else 0 end as error
        from dated d left join (select s.g, s.i, avg(s.v) over (partition by s.g, (s.i - 1) % {period}) as s, t.v as t
            from season2 s join trend2 t using (g, i)) x using (g, i))""")
    return ",\n    ".join(parts)


def shifts_sql(weekly: str, beta: float, on_differences: bool = False, min_size: int = 26) -> str:
    """CTEs up to ``shifts`` (g, w, y, shift): the penalized segmentation by medians of ``weekly`` (g, w, y), for ``with recursive``.

    ``medians`` has the median of every run of points, as a list by end for each start; ``best`` goes once over all
    places of a shift and keeps, for every end, the best sum and the last shift before it.
    """
    value = "y - lag(y) over (partition by g order by w)" if on_differences else "y"
    offset = 1 if on_differences else 0
    return f"""said as materialized ({weekly}),
    numbered as materialized (select g, w, y, row_number() over (partition by g order by w) as i from said where y is not null),
    valued as (select g, w, {value} as v from said where y is not null),
    points as materialized (select g, i, n, (v - low) / (high - low) as v from (
        select g, v, row_number() over (partition by g order by w) as i, count(*) over (partition by g) as n,
            min(v) over (partition by g) as low, max(v) over (partition by g) as high from valued where v is not null)
        where n >= {2 * min_size} and high > low),
    medians as materialized (select g, a, list(m order by b) as m from (
        select s.g, s.i - 1 as a, e.i as b, median(e.v) over (partition by s.g, s.i order by e.i rows unbounded preceding) as m
        from points s join points e on e.g = s.g and e.i >= s.i) group by g, a),
    best(g, n, place, total, last) as (
        select distinct g, n, cast({min_size - 1} as bigint), list_transform(range(n + 1), lambda x: 0.0::double), list_transform(range(n + 1), lambda x: 0::bigint) from points
        union all
        select g, n, place, list_transform(range(n + 1), lambda x: greatest(total[x + 1], news[x + 1])),
            list_transform(range(n + 1), lambda x: case when news[x + 1] > total[x + 1] then place else last[x + 1] end)
        from (select b.g, b.n, b.place + 1 as place, b.total, b.last, list_transform(range(b.n + 1), lambda x:
                case when b.place + 1 - b.last[b.place + 2] >= {min_size} and x >= b.place + 1 + {min_size} then
                    b.total[b.place + 2] + cast((b.place + 1 - b.last[b.place + 2]) * (x - b.place - 1) as double) / ((x - b.last[b.place + 2]) * b.n)
                        * pow(l.m[b.place + 1 - b.last[b.place + 2]] - r.m[x - b.place - 1], 2) - {beta!r}
                else -1.0::double end) as news
            from best b join medians r on r.g = b.g and r.a = b.place + 1 join medians l on l.g = b.g and l.a = b.last[b.place + 2]
            where b.place + 1 <= b.n - {min_size})),
    ended as materialized (select g, n, last from best where place = n - {min_size}),
    found(g, p, last) as (
        select g, last[n + 1], last from ended
        union all
        select g, last[p + 1], last from found where p > 0),
    shifts as (select f.g, k.w, k.y, cast(row_number() over (partition by f.g order by f.p) as int) as shift
        from found f join numbered k on k.g = f.g and k.i = f.p + {offset} where f.p > 0)"""
