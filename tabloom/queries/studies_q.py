"""Whole studies on the driver's tables."""

from pyspark.sql import functions as F

from tabloom.queries.registry import Tables, query, rounded
from tabloom.studies import applicants, borrowers, customers, listings, panel, survey, transport

CLIENTS = """
    (select o_orderkey, c_nationkey as children, case when o_orderstatus = 'F' then 1 else 0 end as debt, o_orderpriority as income_type,
       case when o_orderstatus <> 'P' then o_totalprice end as income from orders join customer on o_custkey = c_custkey)
"""


def clients(t: Tables):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    purpose = F.when(F.col("c_mktsegment") == "AUTOMOBILE", "покупка автомобиля").when(F.col("c_mktsegment") == "BUILDING", "строительство жилья")
    return joined.select(
        "o_orderkey",
        F.col("c_nationkey").alias("children"),
        (F.col("o_orderstatus") == "F").cast("int").alias("debt"),
        F.col("o_orderpriority").alias("income_type"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("total_income"),
        F.when(F.col("o_orderstatus") != "O", -F.col("c_acctbal")).alias("days_employed"),
        F.col("c_mktsegment").alias("education"),
        purpose.alias("purpose"),
    )


@query(
    "study_default_rates_by_income_band",
    f"""
    with c as {CLIENTS}, m as (select income_type, median(income) as med from c group by 1),
    f as (select debt, trunc(coalesce(income, med))::bigint as v from c join m using (income_type) where children <> 20)
    select case when v between 0 and 30000 then 'E' when v between 30001 and 50000 then 'D' when v between 50001 and 200000 then 'C'
      when v between 200001 and 1000000 then 'B' else 'A' end as total_income_category, round(avg(debt), 9) as rate, count(debt) as n from f group by 1
    """,
)
def default_rates(t: Tables):
    return rounded(borrowers.default_rates(borrowers.clean_clients(clients(t)), "total_income_category"), 9)


@query(
    "study_default_rates_by_purpose",
    """
    select case c_mktsegment when 'AUTOMOBILE' then 'операции с автомобилем' when 'BUILDING' then 'операции с недвижимостью'
      else 'нет категории' end as purpose_category, round(avg((o_orderstatus = 'F')::int), 9) as rate, count(*) as n
    from orders join customer on o_custkey = c_custkey group by 1
    """,
)
def default_rates_purpose(t: Tables):
    return rounded(borrowers.default_rates(borrowers.with_categories(clients(t)), "purpose_category"), 9)


@query(
    "study_price_by_locality",
    """
    select p_brand as locality, count(*) as count, round(avg(l_extendedprice / l_quantity), 6) as mean from lineitem join part on l_partkey = p_partkey
    group by 1 order by count desc, locality limit 10
    """,
)
def price_by_locality(t: Tables):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("locality"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price")
    )
    return rounded(listings.price_by_locality(rows, "locality", "price"))


@query(
    "study_price_per_km",
    """
    with g as (select round_even(l_extendedprice / 2000, 0)::bigint as km, median(l_extendedprice / l_quantity) as median from lineitem group by 1)
    select km, round(median, 6) as median, coalesce(trunc(median - lag(median) over (order by km)), 0)::bigint as diff from g
    """,
)
def price_per_km(t: Tables):
    rows = t.lineitem.select((F.col("l_extendedprice") / 2000).alias("d"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("p"))
    return rounded(listings.price_per_km(rows, "d", "p", city=None))


KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
PLACES = """case when l_partkey % 13 > 0 then case l_partkey % 4 when 0 then 'Санкт-Петербург' when 1 then 'посёлок Берёзовка'
      when 2 then 'деревня Новая' else concat('Село Новая ', l_suppkey % 5) end end"""
#: Lines as flat listings; the same text is SQL on both sides.
LISTING = {
    "last_price": "l_extendedprice", "total_area": "l_quantity * 4.5", "rooms": "l_linenumber - 1", "floor": "cast(1 + l_partkey % 9 as int)",
    "studio": "l_returnflag = 'R'", "open_plan": "case when l_linestatus = 'O' then l_tax > 0.04 end", "is_apartment": "case when l_tax > 0.01 then l_tax > 0.06 end",
    "ceiling_height": "case when l_suppkey % 3 > 0 then l_extendedprice / 10000 end", "floors_total": "cast(1 + l_suppkey % 40 as double)",
    "locality_name": PLACES, "living_area": "case when l_tax > 0.02 then l_extendedprice / 1000 end",
    "kitchen_area": "case when l_discount > 0.05 then l_extendedprice / 5000 end", "balcony": "case when l_discount > 0.03 then l_discount * 100 end",
    "airports_nearest": "case when l_orderkey % 5 > 0 then l_extendedprice end", "cityCenters_nearest": "case when l_orderkey % 7 > 0 then l_extendedprice * 2 end",
    "parks_around3000": "l_tax * 100", "parks_nearest": "case when l_orderkey % 3 > 0 and l_partkey % 4 <> 2 then l_extendedprice / 3 end",
    "ponds_around3000": "case when l_tax > 0.03 then l_tax end", "ponds_nearest": "case when l_tax > 0.05 then l_extendedprice end",
    "days_exposition": "case when l_discount > 0.01 then l_quantity end",
}


def _stripped(c: str) -> str:
    c = f"replace(lower({c}), 'ё', 'е')"
    for word in listings.LOCALITY_WORDS:
        c = f"replace({c}, '{word}', '')"
    return c


CLEAN = f"""
    raw as (select {', '.join(KEY)}, l_shipdate, {', '.join(f'{v} as {k}' for k, v in LISTING.items())} from lineitem),
    a as (select * replace (case when rooms = 0 and studio then 1 else rooms end as rooms) from raw where total_area <= 190 and rooms <= 5),
    q as (select quantile_cont(ceiling_height, 0.995) as cap, median(ceiling_height) as mid from a),
    b as (select a.* replace (case when ceiling_height > cap then mid else ceiling_height end as ceiling_height) from a, q),
    c as (select * replace (coalesce(ceiling_height, median(ceiling_height) over ()) as ceiling_height) from b),
    d as (select * from c where floors_total <= 35 and locality_name is not null),
    m as (select rooms, round_even(avg(living_area), 0) as m from d group by rooms having avg(living_area) is not null),
    u as (select round_even(sum(m) / sum(rooms), 0) as unit from m),
    e as (select d.* replace (coalesce(living_area, rooms * unit) as living_area, {_stripped('locality_name')} as locality_name,
        case when kitchen_area is null and (studio or coalesce(open_plan, false)) then 0 else kitchen_area end as kitchen_area) from d, u),
    f as (select * replace (
        case when airports_nearest is null and locality_name <> '{listings.CITY}' then median(airports_nearest) over p else airports_nearest end as airports_nearest,
        case when cityCenters_nearest is null and locality_name <> '{listings.CITY}' then median(cityCenters_nearest) over p else cityCenters_nearest end as cityCenters_nearest,
        coalesce(parks_nearest, median(parks_nearest) over p) as parks_nearest) from e window p as (partition by locality_name)),
    clean as (select * exclude (cityCenters_nearest, airports_nearest, kitchen_area, parks_nearest, is_apartment, balcony, days_exposition),
        coalesce(cityCenters_nearest, -1) as city_centers_nearest, coalesce(airports_nearest, -1) as airports_nearest, coalesce(kitchen_area, -1) as kitchen_area,
        coalesce(parks_nearest, median(parks_nearest) over ()) as parks_nearest, coalesce(is_apartment, false) as is_apartment, coalesce(balcony, 0) as balcony,
        coalesce(days_exposition, -1) as days_exposition from f)
"""
CLEANED = [
    "rooms", "ceiling_height", "living_area", "kitchen_area", "locality_name", "airports_nearest", "city_centers_nearest", "parks_nearest", "is_apartment",
    "balcony", "days_exposition",
]


def raw_listings(t: Tables):
    rows = t.lineitem.select(*KEY, F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("first_day_exposition"), *(F.expr(v).alias(k) for k, v in LISTING.items()))
    return rows


def _rounded_sql(names: list[str], numbers: set[str]) -> str:
    return ", ".join(f"round({c}, 6) as {c}" if c in numbers else c for c in names)


NUMBERS = set(CLEANED) - {"rooms", "locality_name", "is_apartment"}


@query("study_clean_listings", f"with {CLEAN} select {', '.join(KEY)}, {_rounded_sql(CLEANED, NUMBERS)} from clean")
def clean_listings(t: Tables):
    return rounded(listings.clean_listings(raw_listings(t)).select(*KEY, *CLEANED))


@query(
    "study_listing_features",
    f"""
    with {CLEAN} select {', '.join(KEY)}, round(last_price / total_area, 6) as price_sq_meter, (isodow(l_shipdate) - 1)::int as weekday_exposition,
      month(l_shipdate)::int as month_exposition, year(l_shipdate)::int as year_exposition, round(city_centers_nearest / 1000, 9) as city_centers_nearest_km,
      case when floor = 1 then 'первый' when floor = floors_total then 'последний' else 'другой' end as floor_group from clean
    """,
)
def listing_features(t: Tables):
    out = listings.with_features(listings.clean_listings(raw_listings(t)))
    names = ["price_sq_meter", "weekday_exposition", "month_exposition", "year_exposition", "city_centers_nearest_km", "floor_group"]
    return rounded(rounded(out.select(*KEY, *names), 6, ["price_sq_meter"]), 9, ["city_centers_nearest_km"])


@query(
    "study_price_extremes",
    f"""
    with {CLEAN}, g as (select locality_name, count(*) as count, avg(last_price / total_area) as mean from clean group by 1)
    select locality_name, count, round(mean, 6) as mean, 'highest' as edge from g where mean = (select max(mean) from g)
    union all select locality_name, count, round(mean, 6), 'lowest' from g where mean = (select min(mean) from g)
    """,
)
def price_extremes(t: Tables):
    return rounded(listings.price_extremes(listings.with_features(listings.clean_listings(raw_listings(t)))))


@query(
    "study_satisfaction",
    """
    with a as (select user_id, case event_type when 'click' then 'B0' when 'purchase' then 'A0' when 'error' then 'C0' else 'Q' end as q,
        case when value < 5 then 'да' when value < 10 then 'нет' else 'скорее да' end as g from events),
    s as (select user_id, case when q in ('B0', 'A0') then 'positive' when q = 'C0' then 'negative' end as side,
        case g when 'да' then 2 when 'скорее да' then 1 when 'нет' then -2 end as points from a),
    b as (select user_id, sum(points) filter (side = 'positive') as positive, sum(points) filter (side = 'negative') as negative
          from s where side is not null group by user_id)
    select user_id, 'designer' as profession_name, positive::bigint as positive, negative::bigint as negative, (positive - negative)::bigint as score,
      user_id in (select o_custkey from orders where o_orderstatus = 'F') as is_in_goals,
      user_id in (select o_custkey from orders where o_orderstatus = 'P') as is_in_returns from b
    """,
)
def satisfaction(t: Tables):
    code = F.when(F.col("event_type") == "click", "B0").when(F.col("event_type") == "purchase", "A0").when(
        F.col("event_type") == "error", "C0").otherwise("Q")
    grade = F.when(F.col("value") < 5, "да").when(F.col("value") < 10, "нет").otherwise("скорее да")
    answers = t.events.select(
        "user_id", F.lit("designer").alias("profession_name"), code.alias("question_number"), grade.alias("grade_content")
    )
    of = lambda s: t.orders.filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("user_id"))
    return survey.satisfaction(answers, of("F"), of("P"))


@query(
    "study_goal_importance",
    """
    with r as (select distinct user_id from events where event_type = 'error' and value > 20),
    g as (select e.event_type as statement_content, e.value, r.user_id is not null as refunded from events e left join r using (user_id))
    select statement_content, round(sum(value) / (select sum(value) from g), 9) as everyone,
      round(sum(value) filter (not refunded) / (select sum(value) from g where not refunded), 9) as kept,
      round(sum(value) filter (refunded) / (select sum(value) from g where refunded), 9) as refunded from g group by 1
    """,
)
def goal_importance(t: Tables):
    refunds = t.events.filter("event_type = 'error' and value > 20").select("user_id").distinct().withColumn("refund_reason", F.lit("r"))
    goals = t.events.select("user_id", F.col("event_type").alias("statement_content"), "value")
    return rounded(survey.goal_importance(goals, refunds), 9)


@query(
    "study_trade_panel",
    """
    with e as (select o_custkey as country, year(o_orderdate)::int as year, sum(o_totalprice) filter (o_orderstatus = 'F') as export,
      sum(o_totalprice) filter (o_orderstatus = 'O') as import, sum(o_totalprice) as gdp from orders group by all)
    select country, year, round(ln(export / gdp), 6) as export_share, round(case when export + import > 0 then ln((export + import) / gdp) end, 6) as turnover_share
    from e where export is not null and country not in (1, 2, 3)
    """,
)
def trade_panel(t: Tables):
    rows = t.orders.withColumn("year", F.year("o_orderdate"))
    by = lambda cond: rows.groupBy("o_custkey", "year").agg(F.sum(F.when(cond, F.col("o_totalprice"))).alias("v"))
    status = F.col("o_orderstatus")
    out = panel.assemble(by(status == "F"), by(status == "O"), by(F.lit(True)), [1, 2, 3])
    return rounded(out.select("country", "year", "export_share", "turnover_share"))


YEARS = """
    o as (select n_nationkey as k, n_name, year(o_orderdate)::int as year, o_totalprice as p, o_orderstatus as s
      from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey),
    e as (select k, n_name, year, sum(p) filter (s = 'F') as export, sum(p) filter (s = 'O') as import, sum(p) as gdp from o group by all),
    pan as (select 'Republic of ' || n_name as country, k, n_name, year, export from e where export is not null and import is not null),
    r as (select distinct country, n_name, k from pan),
    code as (select r.country, substr(md5(c.n_name), 1, 4) as iso2Code, row_number() over (partition by r.country order by
        round(1 - levenshtein(r.country, 'Republik of ' || c.n_name) / greatest(length(r.country), 12 + length(c.n_name)), 12) desc, 'Republik of ' || c.n_name) as rn
      from r, (select distinct n_name from nation) c where 1 - levenshtein(r.country, 'Republik of ' || c.n_name) / greatest(length(r.country), 12 + length(c.n_name)) >= 0.9 - 1e-12),
    ind as (select substr(md5(n_name), 1, 4) as iso2Code, year, max(case when (year + k) % 3 > 0 then nullif(round(gdp, 2), 0) end) as gini,
        max(case when (year * 7 + k) % 4 > 0 then nullif(round(gdp / 1000, 2), 0) end) as industry from e group by all),
    wide as (select pan.country, pan.year, pan.export, gini, industry from pan left join code on code.country = pan.country and rn = 1
      left join ind on ind.iso2Code = code.iso2Code and ind.year = pan.year)
"""
FILLED_PANEL = YEARS + """,
    i as (select *, row_number() over (partition by country order by year) as pos from wide),
    j as (select *, last_value(industry ignore nulls) over b as pv, last_value(case when industry is not null then pos end ignore nulls) over b as pp,
        first_value(industry ignore nulls) over a as nv, first_value(case when industry is not null then pos end ignore nulls) over a as np,
        last_value(gini ignore nulls) over b as gp, lead(gini) over (partition by country order by pos) as gn
      from i window b as (partition by country order by pos rows between unbounded preceding and 1 preceding),
                    a as (partition by country order by pos rows between 1 following and unbounded following)),
    filled as (select country, year, export, coalesce(industry, pv + (nv - pv) * (pos - pp) / (np - pp), pv) as industry, coalesce(gini, (gp + gn) / 2, gp, gn) as gini from j)
"""


def panel_rows(t: Tables):
    """A panel of nations, with codes under a slightly different name, and long indicator rows with gaps."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.withColumn("year", F.year("o_orderdate"))
    of = lambda cond: F.sum(F.when(cond, F.col("o_totalprice")))
    by = rows.groupBy("n_nationkey", "n_name", "year").agg(of(F.col("o_orderstatus") == "F").alias("export"), of(F.col("o_orderstatus") == "O").alias("import"), F.sum("o_totalprice").alias("gdp"))
    code = F.substring(F.md5(F.col("n_name").cast("binary")), 1, 4).alias("iso2Code")
    side = lambda c: by.select(F.concat(F.lit("Republic of "), "n_name").alias("country"), "year", c)
    codes = t.nation.select(F.concat(F.lit("Republik of "), "n_name").alias("name"), code).distinct()
    gini = F.when((F.col("year") + F.col("n_nationkey")) % 3 > 0, F.round("gdp", 2))
    industry = F.when((F.col("year") * 7 + F.col("n_nationkey")) % 4 > 0, F.round(F.col("gdp") / 1000, 2)).otherwise(F.lit(0.0))
    long = by.select(code, "year", F.explode(F.array(
        F.struct(F.lit("GINI").alias("indicator"), gini.alias("value")), F.struct(F.lit("IND").alias("indicator"), industry.alias("value")))).alias("x")).select("iso2Code", "year", "x.*")
    rows = panel.assemble(side("export"), side("import").filter("import is not null"), side("gdp"))
    return panel.with_indicators(rows, codes, long, {"GINI": "gini", "IND": "industry"})


@query("study_panel_with_indicators", f"with {YEARS} select country, year, round(gini, 2) as gini, round(industry, 2) as industry from wide")
def panel_indicators(t: Tables):
    return rounded(panel_rows(t).select("country", "year", "gini", "industry"), 2)


@query("study_fill_panel", f"with {FILLED_PANEL} select country, year, round(gini, 4) as gini, round(industry, 4) as industry from filled")
def fill_panel(t: Tables):
    return rounded(panel.fill_panel(panel_rows(t), ["industry"], ["gini"]).select("country", "year", "gini", "industry"), 4)


@query(
    "study_panel_regression",
    f"""
    with {FILLED_PANEL}, x as (select year as g, ln(1 + export) as x, industry as y from filled where export is not null and industry is not null),
    mm as (select g, avg(x) as mx, avg(y) as my from x group by g),
    bb as (select sum((x - mx) * (y - my)) / sum((x - mx) * (x - mx)) as b from x join mm using (g)),
    ff as (select g, my - b * mx as a from mm, bb), z as (select a from ff order by g limit 1)
    select 'log_export' as term, round(b, 3) as coef from bb union all select 'const', round(a, 3) from z
    union all select 'year_' || g, round(ff.a - z.a, 3) from ff, z where g > (select min(g) from ff)
    """,
)
def panel_regression(t: Tables):
    filled = panel.fill_panel(panel_rows(t), ["industry"], ["gini"])
    return panel.regress(filled, "industry", ["export"], ["export"]).coefficients.select("term", F.round("coef", 3).alias("coef"))


@query(
    "study_goals_by_reason",
    """
    with r as (select o_custkey as user_id, min(case o_orderpriority when '1-URGENT' then 'Перевожусь на другой курс' when '2-HIGH' then 'Другое' else 'Нет времени' end) as reason
      from orders where o_orderstatus = 'P' group by 1),
    g as (select event_type as statement_content, value, case reason when 'Перевожусь на другой курс' then 'Перевожусь' when 'Другое' then null else reason end as reason
      from events left join r using (user_id))
    select statement_content, round(sum(value) filter (reason = 'Перевожусь'), 4) as moved, round(sum(value) filter (reason = 'Нет времени'), 4) as busy from g group by 1
    """,
)
def goals_by_reason(t: Tables):
    reason = F.when(F.col("o_orderpriority") == "1-URGENT", "Перевожусь на другой курс").when(F.col("o_orderpriority") == "2-HIGH", "Другое").otherwise("Нет времени")
    refunds = t.orders.filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("user_id")).agg(F.min(reason).alias("refund_reason"))
    goals = t.events.select("user_id", F.col("event_type").alias("statement_content"), "value")
    wide = survey.goals_by_reason(goals, refunds, {"Перевожусь на другой курс": "Перевожусь"}, ["Перевожусь", "Нет времени"])
    return rounded(wide.toDF("statement_content", "moved", "busy"), 4)


def _edited(c: str) -> str:
    for old, new in survey.COHORT_EDITS:
        c = f"replace({c}, '{old}', '{new}')"
    return c


COHORT = "concat(case when o_custkey % 2 = 0 then 'designer-plus' else 'data_praktikum' end, '_', o_orderkey % 12, case when o_orderkey % 3 = 0 then '_dop' else '_months' end)"


@query("study_unify_cohorts", f"select o_orderkey, {_edited(COHORT)} as cohort, {_edited('o_clerk')} as current_cohort from orders".replace("o_clerk", "concat('C', o_orderkey % 20, '_8')"))
def unify_cohorts(t: Tables):
    rows = t.orders.select("o_orderkey", F.expr(COHORT).alias("cohort"), F.expr("concat('C', o_orderkey % 20, '_8')").alias("current_cohort"))
    return survey.unify_cohorts(rows)


@query(
    "study_customer_features",
    """
    with m as (select user_id as id, avg(value) filter (event_type = 'click') as current, avg(value) filter (event_type = 'view') as previous from events group by 1),
    k as (select * from m where current < (select max(current) from m) and previous > 0),
    n as (select user_id as id, avg(value * 2) filter (event_type = 'click') as current from events group by 1)
    select c_custkey as id, c_mktsegment as segment, round(k.current, 6) as current, round(k.previous, 6) as previous,
      round(n.current, 6) as current_minutes, round(k.current / k.previous - 1, 6) as revenue_change
    from customer join k on c_custkey = k.id join n on n.id = k.id
    """,
)
def customer_features(t: Tables):
    period = F.when(F.col("event_type") == "click", "current").when(F.col("event_type") == "view", "previous")
    money = t.events.select(F.col("user_id").alias("id"), period.alias("period"), "value")
    minutes = money.withColumn("value", F.col("value") * 2)
    market = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    df = customers.features(market, money, minutes, ["current", "previous"], ["current"], "current", "previous")
    return rounded(customers.revenue_change(df, "current", "previous"))


def _exams(t: Tables):
    points = F.when(F.col("o_orderstatus") == "P", applicants.ABSENT).otherwise(F.floor(F.col("o_totalprice") / 5000).cast("string"))
    econ = t.orders.select(F.col("o_orderkey").alias("id"), points.alias("econ_points"))
    stat = t.lineitem.filter("l_linenumber = 1").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.floor(F.max("l_quantity")).cast("string").alias("stat_points")
    )
    extra = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(F.count(F.lit(1)).alias("additional_points"))
    final = t.orders.filter("o_orderpriority <> '5-LOW'").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("final_rating"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "да").otherwise(applicants.NO_CONSENT).alias("acceptance"),
        F.floor(F.col("o_totalprice") / 4000).alias("total_points"),
    )
    return applicants.results(econ, stat, extra, final)


RESULTS = """
    (select o_orderkey as id, (o_orderstatus = 'P') as econ_missing, case when o_orderstatus = 'P' then 0 else floor(o_totalprice / 5000) end as econ_points,
       coalesce(s.p, 0) as stat_points, coalesce(x.n, 0) as additional_points, o_orderpriority <> '5-LOW' as listed, o_orderpriority = '1-URGENT' as agreed,
       case when o_orderpriority <> '5-LOW' then floor(o_totalprice / 4000) end as total_points, case when o_orderpriority <> '5-LOW' then o_orderkey end as final_rating
     from orders left join (select l_orderkey, floor(max(l_quantity)) as p from lineitem where l_linenumber = 1 group by 1) s on s.l_orderkey = o_orderkey
     left join (select l_orderkey, count(*) as n from lineitem group by 1) x on x.l_orderkey = o_orderkey)
"""


@query(
    "study_applicant_funnel",
    f"""
    with r as {RESULTS}, c as (select count(*)::bigint as a, count_if(not econ_missing)::bigint as b, count_if(not econ_missing and econ_points >= 36)::bigint as c,
      count_if(not econ_missing and econ_points >= 36 and stat_points >= 22)::bigint as d, count_if(listed)::bigint as e, count_if(agreed)::bigint as f from r)
    select unnest([1, 2, 3, 4, 5, 6]) as step,
      unnest(['applied', 'wrote the first exam', 'passed the first exam', 'passed the second exam', 'in the final list', 'agreed']) as stage,
      unnest([a, b, c, d, e, f]) as n, round(unnest([a, b, c, d, e, f]) * 100.0 / a, 6) as percent from c
    """,
)
def applicant_funnel(t: Tables):
    return rounded(applicants.admission_funnel(_exams(t)))


@query(
    "study_applicant_rating",
    f"""
    with r as (select id, (econ_points + stat_points + additional_points)::int as sum_points from {RESULTS})
    select id, sum_points, rank() over (order by sum_points desc) as place_first,
      rank() over (order by sum_points desc) + count(*) over (partition by sum_points) - 1 as place_last from r
    """,
)
def applicant_rating(t: Tables):
    scored = applicants.rating(_exams(t))
    return scored.withColumn("sum_points", F.col("sum_points").cast("int"))


TOPS = {
    "first exam": "econ_points desc", "both exams": "econ_points + stat_points desc",
    "all points": "total_points desc nulls last", "final list": "final_rating asc nulls last",
}
TOP_SQL = {n: f"(select id from r order by {o}, id limit 44)" for n, o in TOPS.items()}
EDGES = " union all ".join(
    f"select '{a}' as source, '{b}' as target, count_if(id in {TOP_SQL[b]})::bigint as value from {TOP_SQL[a]} union all "
    f"select '{a}', 'left {a}', count_if(id not in {TOP_SQL[b]})::bigint from {TOP_SQL[a]}"
    for a, b in zip(list(TOPS), list(TOPS)[1:])
)


@query("study_applicant_turnover", f"with r as {RESULTS} {EDGES}")
def applicant_turnover(t: Tables):
    return applicants.turnover(_exams(t))


@query(
    "study_transport_layers",
    """
    select 'Canada' as country, 'Air' as transport, null::varchar as geometry, c_name as name, 'airport' as type, c_nationkey as scalerank, c_acctbal as natrlscale,
      null::varchar as abbrev, c_mktsegment as website, null::varchar as road_class from customer
    union all select 'Canada', 'Sea', null, s_name, 'port', null, s_acctbal, null, null, null from supplier
    """,
)
def transport_layers(t: Tables):
    air = transport.layer(
        t.customer, "Canada", "Air",
        {"c_name": "name", "c_nationkey": "scalerank", "c_acctbal": "natrlscale", "c_mktsegment": "website"}, {"type": "airport"},
    )
    sea = transport.layer(t.supplier, "Canada", "Sea", {"s_name": "name", "s_acctbal": "natrlscale"}, {"type": "port"})
    return transport.stack([air, sea])
