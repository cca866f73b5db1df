"""Whole studies on small frames with the schemas they were written for."""

import pytest
from pyspark.sql import functions as F

from tabloom.streaming import dedupe_stream, drain
from tabloom.studies import applicants, borrowers, customers, listings, panel, survey, transport


def test_borrowers(spark):
    rows = [
        (1, -100.0, "Высшее", "сотрудник", 0, 40000.5, "покупка жилья"),
        (0, None, "высшее", "сотрудник", 1, None, "свадьба"),
        (20, 5.0, "среднее", "сотрудник", 1, 99999.0, "на автомобиль"),
        (0, 50.0, "среднее", "пенсионер", 0, 20000.0, "образование"),
        (0, 50.0, "СРЕДНЕЕ", "пенсионер", 0, 20000.0, "образование"),
    ]
    df = spark.createDataFrame(
        rows, "children int, days_employed double, education string, income_type string, debt int, total_income double, purpose string"
    )
    out = {r.purpose: r for r in borrowers.clean_clients(df).collect()}
    assert len(out) == 3
    # the income median is taken before rows with impossible children go
    assert out["свадьба"].total_income == 69999 and out["свадьба"].days_employed == 100.0
    assert out["покупка жилья"].total_income_category == "D"
    assert out["образование"].purpose_category == "получение образования"
    rate = {r.children: (r.rate, r.n) for r in borrowers.default_rates(borrowers.clean_clients(df), "children").collect()}
    assert rate == {1: (0.0, 1), 0: (0.5, 2)}


LISTING = (
    "last_price double, total_area double, first_day_exposition string, rooms int, ceiling_height double, floors_total double,"
    " living_area double, floor int, is_apartment boolean, studio boolean, open_plan boolean, kitchen_area double, balcony double,"
    " locality_name string, airports_nearest double, cityCenters_nearest double, parks_around3000 double, parks_nearest double,"
    " ponds_around3000 double, ponds_nearest double, days_exposition double"
)


def listing(**kw):
    base = dict(
        last_price=1e6, total_area=50.0, first_day_exposition="2019-03-07T00:00:00", rooms=1, ceiling_height=2.5, floors_total=5.0,
        living_area=20.0, floor=1, is_apartment=None, studio=False, open_plan=False, kitchen_area=8.0, balcony=None,
        locality_name="Санкт-Петербург", airports_nearest=100.0, cityCenters_nearest=1400.0, parks_around3000=1.0, parks_nearest=10.0,
        ponds_around3000=1.0, ponds_nearest=5.0, days_exposition=3.0,
    )
    return tuple({**base, **kw}.values())


def test_listings(spark):
    rows = [
        listing(), listing(total_area=500.0), listing(rooms=0, studio=True, kitchen_area=None, locality_name="посёлок Новый"),
        listing(locality_name="деревня Новая", living_area=None, rooms=2, airports_nearest=None, last_price=2e6),
        listing(locality_name="Новая", airports_nearest=300.0, floor=5, cityCenters_nearest=2600.0),
        listing(locality_name=None), listing(cityCenters_nearest=3500.0, last_price=3e6),
    ]
    df = listings.with_features(listings.clean_listings(spark.createDataFrame(rows, LISTING)))
    got = df.collect()
    assert len(got) == 5
    new = [r for r in got if r.locality_name == "новая"]
    assert {r.airports_nearest for r in new} == {300.0}
    assert [r.living_area for r in new if r.rooms == 2] == [pytest.approx(2 * 20.0)]
    village = next(r for r in got if r.locality_name == "новый")
    assert (village.rooms, village.kitchen_area, village.is_apartment, village.balcony) == (1, 0.0, False, 0.0)
    assert village.weekday_exposition == 3 and village.floor_group == "первый"
    km = {r.km: (r.median, r.diff) for r in listings.price_per_km(df).collect()}
    assert km == {1: (20000.0, 0), 4: (60000.0, 40000)}
    top = listings.price_by_locality(df, k=1).first()
    assert (top.locality_name, top["count"]) == ("новая", 2)
    edges = {r.edge: r.locality_name for r in listings.price_extremes(df).collect()}
    assert edges["highest"] == "санкт-петербург"


def test_survey(spark):
    answers = spark.createDataFrame(
        [(1, "designer", "B0", "да"), (1, "designer", "C0", "скорее нет"), (1, "designer", "ZZ", "да"), (2, "designer", "A0", "нет")],
        "user_id int, profession_name string, question_number string, grade_content string",
    )
    users = lambda *u: spark.createDataFrame([(x,) for x in u], "user_id int")
    got = {r.user_id: (r.score, r.is_in_goals, r.is_in_returns) for r in survey.satisfaction(answers, users(1), users(2, 2)).collect()}
    assert got == {1: (3, True, False), 2: (None, False, True)}
    goals = spark.createDataFrame([(1, "g1", 2.0), (2, "g1", 1.0), (2, "g2", 1.0)], "user_id int, statement_content string, value double")
    refunds = spark.createDataFrame([(2, "Перевожусь на другой курс")], "user_id int, refund_reason string")
    share = {r.statement_content: (r.everyone, r.kept, r.refunded) for r in survey.goal_importance(goals, refunds).collect()}
    assert share == {"g1": (0.75, 1.0, 0.5), "g2": (0.25, None, 0.5)}
    wide = survey.goals_by_reason(goals, refunds, {"Перевожусь на другой курс": "Перевожусь"}, ["Перевожусь"])
    assert {r.statement_content: r["Перевожусь"] for r in wide.collect()} == {"g1": 1.0, "g2": 1.0}
    cohort = spark.createDataFrame([("designer-plus_8_praktikum", "C_9_dop")], "cohort string, current_cohort string")
    assert tuple(survey.unify_cohorts(cohort).first()) == ("designer_plus_08", "_09")


def test_panel(spark):
    years = range(2000, 2006)
    rows = [(c, y, 10.0 + y - 2000 + i) for i, c in enumerate(["Freedonia North", "Sylvania", "Tokelau"]) for y in years]
    side = lambda k: spark.createDataFrame([(c, y, v * k) for c, y, v in rows], "a string, b int, c double")
    df = panel.assemble(side(1.0), side(2.0), side(10.0), ["Tokelau"])
    assert df.count() == 12 and df.first().export_share == pytest.approx(-2.302585, abs=1e-5)
    codes = spark.createDataFrame([("Freedonia Nort", "FN"), ("Sylvania", "SY")], "name string, iso2Code string")
    long = spark.createDataFrame(
        [("FN", y, "gini", 30.0 + y) for y in years] + [("SY", y, "gini", 40.0 + y * y % 7) for y in years]
        + [("FN", 2000, "ind", 4.0), ("FN", 2002, "ind", 8.0), ("SY", 2003, "ind", 0.0)],
        "iso2Code string, year int, indicator string, value double",
    )
    coded = panel.with_indicators(df, codes, long, {"gini": "gini", "ind": "industry"})
    assert coded.count() == 12 and coded.filter("gini is null").count() == 0
    filled = {r.year: r.industry for r in panel.fill_panel(coded, ["industry"], ["gini"]).filter("iso2Code = 'FN'").collect()}
    assert filled == {2000: 4.0, 2001: 6.0, 2002: 8.0, 2003: 8.0, 2004: 8.0, 2005: 8.0}
    fit = panel.regress(coded, "gini", ["export"], ["export"])
    assert fit.coefficients.count() == 1 + 5 + 1


def test_applicants(spark):
    econ = spark.createDataFrame([(1, "60"), (2, "неявка"), (3, "30"), (4, "40")], "id int, econ_points string")
    stat = spark.createDataFrame([(1, "30"), (2, "неявка"), (4, "неявка")], "id int, stat_points string")
    extra = spark.createDataFrame([(1, 6.0)], "id int, additional_points double")
    final = spark.createDataFrame([(1, 1, "да", 96), (4, 2, "—", 40)], "id int, final_rating int, acceptance string, total_points int")
    df = applicants.results(econ, stat, extra, final)
    got = {r.id: (r.econ_missing, r.stat_missing, r.sum_points) for r in df.collect()}
    # applicant 3 is absent from the second sheet and so counts as present with 0 points
    assert got == {1: (0, 0, 96), 2: (1, 1, 0), 3: (0, 0, 30), 4: (0, 1, 40)}
    assert {r.id: r.place_first for r in applicants.rating(df).collect()} == {1: 1, 4: 2, 3: 3, 2: 4}
    assert [r.n for r in applicants.admission_funnel(df).orderBy("step").collect()] == [4, 3, 2, 1, 2, 1]
    edges = {(r.source, r.target): r.value for r in applicants.turnover(df, 2).collect()}
    assert edges["first exam", "both exams"] == 2 and edges["both exams", "left both exams"] == 0


def test_customers(spark):
    market = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "id int, kind string")
    money = spark.createDataFrame(
        [(i, p, v) for i, a, b in [(1, 10.0, 5.0), (2, 900.0, 5.0), (3, 4.0, 0.0), (4, 6.0, 6.0)] for p, v in [("now", a), ("before", b)]],
        "id int, period string, value double",
    )
    minutes = money.withColumn("value", F.lit(7.0))
    df = customers.features(market, money, minutes, ["now", "before"], ["now"], "now", "before")
    got = {r.id: (r.now, r.now_minutes, r.revenue_change) for r in customers.revenue_change(df, "now", "before").collect()}
    assert got == {1: (10.0, 7.0, 1.0), 4: (6.0, 7.0, 0.0)}


def test_transport(spark):
    roads = spark.createDataFrame([("1", "Highway", "LINESTRING (0 0, 1 1)", 4)], "number string, class string, geometry string, scalerank int")
    rails = spark.createDataFrame([("LINESTRING (2 2, 3 3)", 5)], "geometry string, scalerank int")
    out = transport.stack([
        transport.layer(roads, "Canada", "Road", {"number": "name", "class": "road_class"}),
        transport.layer(rails, "Canada", "Railroad", {}, {"type": "railroad"}),
    ])
    assert sorted((r.transport, r.name, r.type, r.road_class) for r in out.collect()) == [
        ("Railroad", None, "railroad", None), ("Road", "1", None, "Highway"),
    ]


def test_stream_drops_seen_keys_across_runs(spark, tmp_path):
    schema = "link string, ts timestamp"
    feed, out, state = (str(tmp_path / n) for n in ("feed", "out", "state"))
    batch = lambda *rows: spark.createDataFrame(rows, "link string, ts string").select("link", F.to_timestamp("ts").alias("ts"))
    run = lambda: drain(dedupe_stream(spark.readStream.schema(schema).parquet(feed), "link", "ts", "30 days", "2024-01-01"), out, state)
    batch(("a", "2024-01-05"), ("a", "2024-01-05"), ("old", "2023-12-31")).write.mode("append").parquet(feed)
    run()
    batch(("a", "2024-01-06"), ("b", "2024-01-06")).write.mode("append").parquet(feed)
    run()
    assert sorted(r.link for r in spark.read.parquet(out).collect()) == ["a", "b"]
