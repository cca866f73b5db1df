"""Features, classifiers, search, neighbours, attribution."""

from pyspark.sql import functions as F

from tabloom.models import attribution, classify, features, nearest, search
from tabloom.plans.sizing import attach, packed
from tabloom.plans.written import written
from tabloom.queries.registry import Tables, query, rounded

CAT, NUM = ["lang"], ["n_chars", "n_words", "word_length", "marks"]
SOURCE_ORDER = [f"src{i}" for i in range(20)]
HASH = "('0x' || substr(md5({key}::varchar || ':42'), 1, 13))::bigint"


def examples(t: Tables):
    """Labelled documents with a few number features."""
    words = F.size(F.split("text", r"\s+"))
    marks = F.length("text") - F.length(F.translate("text", ".,!?;:#$%&*", ""))
    docs = t.dealt("documents").select(
        "doc_id", "lang", "source", "n_chars", words.alias("n_words"),
        (F.length("text") / words).alias("word_length"), marks.alias("marks"),
    )
    return docs.join(t.labels, "doc_id").withColumn("label", F.col("quality").cast("double"))


SPLIT = f"""
    select doc_id, quality, rn <= floor(0.25 * n + 0.5) as test from (
      select doc_id, quality, row_number() over (partition by quality order by {HASH.format(key='doc_id')}) as rn,
        count(*) over (partition by quality) as n from labels)
"""


@query("l1_stratified_split", SPLIT)
def l1(t: Tables):
    train, test = features.stratified_split(t.labels.select("doc_id", "quality"), "quality", "doc_id")
    return train.withColumn("test", F.lit(False)).unionByName(test.withColumn("test", F.lit(True)))


@query(
    "l2_encode_labels",
    "select c_custkey, (dense_rank() over (order by c_mktsegment) - 1)::int as label, c_mktsegment as decoded from customer",
)
def l2(t: Tables):
    coded, names = features.encode_labels(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment")
    return features.decode_labels(coded, "label", names, "decoded").drop("c_mktsegment")


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
FILLED = """
    (select c_custkey, coalesce(s, (select s from (select case when c_acctbal > 1000 then c_mktsegment end as s from customer)
       where s is not null group by s order by count(*) desc, s limit 1)) as s
     from (select c_custkey, case when c_acctbal > 1000 then c_mktsegment end as s from customer))
"""


@query(
    "l3_one_hot",
    "select c_custkey, " + ", ".join(f"(s = '{s}')::int as seg_{s}" for s in SEGMENTS[1:]) + f" from {FILLED}",
)
def l3(t: Tables):
    gaps = t.customer.select("c_custkey", F.when(F.col("c_acctbal") > 1000, F.col("c_mktsegment")).alias("seg"))
    return features.one_hot(gaps, ["seg"]).drop("seg")


@query(
    "l2_encode_labels_many",
    "select o_orderkey, (dense_rank() over (order by o_custkey::varchar) - 1)::int as label, o_custkey::varchar as decoded from orders",
)
def l2_many(t: Tables):
    rows = t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("who"))
    coded, names = features.encode_labels(rows, "who")
    return features.decode_labels(coded, "label", names, "decoded").drop("who")


@query(
    "l6_sparse_slots",
    """
    with l as (select c, (dense_rank() over (order by c) - 2)::int as slot from (select distinct o_custkey::varchar as c from orders))
    select o_orderkey, case when slot >= 0 then slot end as slot, (select count(*) - 1 from l)::int as size from orders join l on o_custkey::varchar = c
    """,
)
def l6_sparse(t: Tables):
    """One slot per customer but the first, as sparse vectors."""
    rows = t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("who"))
    parts = features.one_hot_vector(rows, ["who"], "slots").select("o_orderkey", F.to_json(F.struct("slots")).alias("j"))
    at = F.from_json("j", "slots struct<type:int,size:int,indices:array<int>,values:array<double>>")["slots"]
    return parts.select("o_orderkey", F.get(at["indices"], F.lit(0)).alias("slot"), at["size"].alias("size"))


@query(
    "l4_ordinal",
    """
    with k as (select o_orderkey, case o_orderpriority when '5-LOW' then 0 when '3-MEDIUM' then 1 when '1-URGENT' then 2 end as p from orders),
    m as (select p from (select p, case p when 0 then '5-LOW' when 1 then '3-MEDIUM' else '1-URGENT' end as name from k where p is not null)
          group by p, name order by count(*) desc, name limit 1)
    select o_orderkey, coalesce(k.p, m.p)::int as place from k, m
    """,
)
def l4(t: Tables):
    out = features.ordinal(t.orders, "o_orderpriority", ["5-LOW", "3-MEDIUM", "1-URGENT"], "place")
    return out.select("o_orderkey", "place")


@query(
    "l5_scale_standard",
    """
    select l_orderkey, l_partkey, l_suppkey, l_linenumber, round((l_quantity - avg(l_quantity) over ()) / stddev_pop(l_quantity) over (), 6) as l_quantity,
      round((l_tax - avg(l_tax) over ()) / stddev_pop(l_tax) over (), 6) as l_tax from lineitem
    """,
)
def l5(t: Tables):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return rounded(features.scale(t.lineitem.select(*keys, "l_quantity", "l_tax"), ["l_quantity", "l_tax"]))


@query(
    "l5_scale_minmax",
    "select c_custkey, round((c_acctbal - min(c_acctbal) over ()) / (max(c_acctbal) over () - min(c_acctbal) over ()), 9) as c_acctbal from customer",
)
def l5_minmax(t: Tables):
    return rounded(features.scale(t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal"], "minmax"), 9)


@query(
    "l6_column_transformer",
    "select c_custkey, "
    + ", ".join(f"(c_mktsegment = '{s}')::int::double as {s.lower()}" for s in SEGMENTS[1:])
    + ", (c_nationkey % 3)::double as zone, round((c_acctbal - avg(c_acctbal) over ()) / stddev_samp(c_acctbal) over (), 6) as balance from customer",
)
def l6(t: Tables):
    rows = t.customer.withColumn("zone", F.concat(F.lit("z"), (F.col("c_nationkey") % 3).cast("string")))
    pipe = features.build_pipeline(["c_mktsegment"], {"zone": ["z0", "z1", "z2"]}, ["c_acctbal"], None)
    names = [s.lower() for s in SEGMENTS[1:]] + ["zone", "balance"]
    spread = features.vector_columns(pipe.fit(rows).transform(rows), "features", names)
    return rounded(spread.select("c_custkey", *names))


def split_examples(t: Tables):
    """Train and test part of one written example table, which every fit reads again."""
    train, test = features.stratified_split(written(examples(t), "examples"), "label", "doc_id")
    return packed(train), test


def _fit_and_score(t: Tables, model, how: str):
    train, test = split_examples(t)
    pipe = features.build_pipeline(CAT, {"source": SOURCE_ORDER}, NUM, model, how)
    return classify.score(pipe.fit(train), test, ["doc_id", "label"])


@query("l7_tree_classifier")
def l7(t: Tables):
    return rounded(_fit_and_score(t, classify.tree_classifier(5), "none"))


def _stump_table(t: Tables):
    """Train and test part of documents with one number feature of few values."""
    rows = written(examples(t).select("doc_id", "label", F.least(F.floor(F.col("n_chars") / 200), F.lit(12)).cast("double").alias("x")), "examples")
    train, test = features.stratified_split(rows, "label", "doc_id")
    return packed(train), test


#: Train and test part, and the best cut of the train part by Gini impurity, with the share of each side; both sides are one where they predict the same.
STUMP = f"""
    d as (select doc_id, quality as y, least(floor(n_chars / 200), 12)::double as x, test from ({SPLIT}) join documents using (doc_id)),
    v as (select x, lead(x) over (order by x) as nx from (select distinct x from d where not test)),
    c as (select (v.x + nx) / 2 as cut, count_if(d.x <= (v.x + nx) / 2)::double as nl, sum(y) filter (d.x <= (v.x + nx) / 2)::double as pl,
        count(*)::double as n, sum(y)::double as p from v, d where nx is not null and not test group by all),
    g as (select *, 2 * (pl / nl) * (1 - pl / nl) * nl / n + 2 * ((p - pl) / (n - nl)) * (1 - (p - pl) / (n - nl)) * (n - nl) / n as gini from c),
    b as (select *, (pl / nl > 0.5) = ((p - pl) / (n - nl) > 0.5) as same from g order by round(gini, 12), cut limit 1),
    s as (select doc_id, y, case when same then p / n when x <= cut then pl / nl else (p - pl) / (n - nl) end as score from d, b where test)
"""


@query("l7_best_split", f"with {STUMP} select doc_id, round(score, 9) as score from s")
def l7_split(t: Tables):
    """A tree of depth 1 cuts where the Gini impurity falls most."""
    train, test = _stump_table(t)
    model = features.build_pipeline([], {}, ["x"], classify.tree_classifier(1), "none").fit(train)
    return rounded(classify.score(model, test, ["doc_id"]).select("doc_id", "score"), 9)


@query("l8_logistic")
def l8(t: Tables):
    return rounded(_fit_and_score(t, classify.logistic(), "standard"), 3)


@query(
    "l8_logistic_group_means",
    "select lang, round(avg(quality), 2) as share from documents join labels using (doc_id) group by lang",
)
def l8_means(t: Tables):
    """Without penalty and on one category, the fitted probabilities are the group means."""
    rows = written(examples(t).select("doc_id", "lang", "label"), "examples")
    fitted = features.build_pipeline(["lang"], {}, [], classify.logistic()).fit(packed(rows))
    return rounded(classify.score(fitted, rows, ["lang"]).groupBy("lang").agg(F.avg("score").alias("share")), 2)


@query("l9_linear_svm")
def l9(t: Tables):
    return rounded(_fit_and_score(t, classify.linear_svm(), "standard"), 3)


@query("l9_wide_margin", f"select doc_id, (n_chars > 500)::int as prediction from ({SPLIT}) join documents using (doc_id) where test")
def l9_margin(t: Tables):
    """Classes that one feature separates with a wide margin are separated."""
    rows = written(examples(t).select("doc_id", "label", F.when(F.col("n_chars") > 500, 3.0).otherwise(-3.0).alias("x"), (F.col("doc_id") % 3).alias("noise")), "examples")
    train, test = features.stratified_split(rows, "label", "doc_id")
    marked = lambda df: df.withColumn("label", (F.col("x") > 0).cast("double"))
    model = features.build_pipeline([], {}, ["x", "noise"], classify.linear_svm(), "standard").fit(packed(marked(train)))
    return classify.score(model, marked(test), ["doc_id"]).select("doc_id", F.col("prediction").cast("int").alias("prediction"))


KNN = f"""
    with e as (select vec_id, label, embedding::double[] as v, row_number() over (partition by label order by {HASH.format(key='vec_id')}) <=
        floor(0.25 * count(*) over (partition by label) + 0.5) as test from embeddings),
    d as (select q.vec_id, t.vec_id as near_id, t.label, round(list_distance(q.v, t.v), 9) as dist from e q, e t where q.test and not t.test),
    k as (select *, row_number() over (partition by vec_id order by dist, near_id) as place from d)
"""


@query("l10_k_nearest", KNN + "select vec_id as query_id, near_id, place::int as place, round(dist, 6) as dist from k where place <= 5")
def l10(t: Tables):
    train, test = features.stratified_split(t.dealt("embeddings"), "label", "vec_id")
    near = nearest.k_nearest(train, test, 5, "vec_id", "embedding", "label")
    return rounded(near.select("query_id", "near_id", "place", "dist"))


@query(
    "l10_knn_classify",
    KNN
    + """, v as (select vec_id, label, count(*) as votes, row_number() over (partition by vec_id order by count(*) desc, label) as rn
      from k where place <= 7 group by vec_id, label)
    select vec_id, label as prediction, votes from v where rn = 1
    """,
)
def l10_classify(t: Tables):
    train, test = features.stratified_split(t.dealt("embeddings"), "label", "vec_id")
    return nearest.knn_classify(train, test, 7, "vec_id", "embedding", "label")


@query("l11_grid_search")
def l11(t: Tables):
    """All 180 candidates (19 numbers of neighbours, 9 depths, support vectors, logistic; 3 scalings, 2 encodings) on each of 5 folds."""
    train, _ = split_examples(t)
    chosen = search.candidates()
    scores = search.fold_scores(train, "doc_id", "label", CAT, {"source": SOURCE_ORDER}, NUM, chosen, parallelism=8)
    return rounded(search.described(scores, chosen), 3)


FOLD = f"({HASH.format(key='doc_id')} % 5)::int"
AUC = "(sum(r) filter (y = 1) - count_if(y = 1) * (count_if(y = 1) + 1) / 2) / nullif(count_if(y = 1)::double * count_if(y = 0), 0)"
RANK = "rank() over (partition by {part} order by s) + (count(*) over (partition by {part}, s) - 1) / 2 as r"
L11_KNN = f"""
    with d as (select doc_id, l.quality as y, n_chars, {FOLD} as fold from documents join labels l using (doc_id)),
    w as (select f.fold, avg(n_chars) as a, stddev_samp(n_chars) as b, min(n_chars)::double as c, max(n_chars) - min(n_chars) as e
      from (select distinct fold from d) f join d on d.fold <> f.fold group by f.fold),
    x as (select w.fold as space, d.*, u.scaling, case u.scaling when 'standard' then (n_chars - a) / b when 'minmax' then (n_chars - c) / e else n_chars end as v
      from d, w, (select unnest(['standard', 'minmax', 'none']) as scaling) u),
    p as (select q.space, q.scaling, q.doc_id, q.y, t.y as tag,
        row_number() over (partition by q.space, q.scaling, q.doc_id order by round(abs(q.v - t.v), 9), t.doc_id) as place
      from x q join x t on q.space = t.space and q.scaling = t.scaling and q.fold = q.space and t.fold <> t.space),
    s as (select k, space as fold, scaling, y, avg(tag) as s from p, (select unnest(range(1, 20)) as k) where place <= k group by k, space, scaling, doc_id, y),
    g as (select *, {RANK.format(part="k, fold, scaling")} from s)
    select k::int as param, fold, scaling, round({AUC}, 6) as auc from g group by k, fold, scaling
"""


@query("l11_neighbours_by_fold", L11_KNN)
def l11_neighbours(t: Tables):
    """The search's neighbour pass on one number column: every k, scaling and fold."""
    rows = written(examples(t).select("doc_id", "label", "n_chars"), "examples")
    chosen = search.candidates(families=["knn"], encodings=["one_hot"])
    found = search.described(search.fold_scores(rows, "doc_id", "label", [], {}, ["n_chars"], chosen), chosen)
    return rounded(found.select("param", "fold", "scaling", "auc"))


@query(
    "l11_saturated_by_fold",
    f"""
    with d as (select doc_id, l.quality as y, lang, {FOLD} as fold from documents join labels l using (doc_id)),
    m as (select f.fold, d.lang, avg(d.y) as s from (select distinct fold from d) f join d on d.fold <> f.fold group by f.fold, d.lang),
    g as (select d.fold, d.y, {RANK.format(part="d.fold").replace("order by s", "order by m.s").replace(", s)", ", m.s)")} from d join m on d.fold = m.fold and d.lang = m.lang)
    select fold, round({AUC}, 6) as auc from g group by fold
    """,
)
def l11_saturated(t: Tables):
    """With one category and no penalty the logistic candidate ranks by the other folds' group means."""
    rows = written(examples(t).select("doc_id", "label", "lang"), "examples")
    chosen = search.candidates(families=["logistic"], encodings=["one_hot"], scalings=["none"])
    return rounded(search.fold_scores(rows, "doc_id", "label", ["lang"], {}, [], chosen).select("fold", "auc"))


@query(
    "l11_stump_by_fold",
    f"""
    with d as (select doc_id, l.quality as y, (n_chars > 500)::int as x, {FOLD} as fold from documents join labels l using (doc_id)),
    m as (select f.fold, d.x, avg(d.y) as s from (select distinct fold from d) f join d on d.fold <> f.fold group by f.fold, d.x),
    one as (select fold, (count(distinct s > 0.5) = 1)::int as same from m group by fold),
    g as (select *, {RANK.format(part="fold")} from (select d.fold, d.y, case when same = 1 then 0 else m.s end as s from d join m on d.fold = m.fold and d.x = m.x join one on one.fold = d.fold))
    select fold, depth::int as param, round({AUC}, 6) as auc from g, (select unnest([2, 5]) as depth) group by fold, depth
    """,
)
def l11_stump(t: Tables):
    """A tree over one 0/1 column: two leaves with the group means, or one if both predict the same class."""
    rows = written(examples(t).select("doc_id", "label", (F.col("n_chars") > 500).cast("int").alias("long")), "examples")
    chosen = search.candidates(depths=[2, 5], families=["tree"], encodings=["one_hot"], scalings=["none"])
    found = search.described(search.fold_scores(rows, "doc_id", "label", [], {}, ["long"], chosen), chosen)
    return rounded(found.select("fold", "param", "auc"))


@query(
    "l12_auc",
    """
    with s as (select n_chars as s, toxic from documents join labels using (doc_id)),
    r as (select toxic, rank() over (order by s) + (count(*) over (partition by s) - 1) / 2 as r from s)
    select round((sum(r) filter (toxic = 1) - count_if(toxic = 1) * (count_if(toxic = 1) + 1) / 2)
      / (count_if(toxic = 1)::double * count_if(toxic = 0)), 9) as auc from r
    """,
)
def l12(t: Tables):
    rows = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id")
    return rounded(classify.auc_rank(rows, "toxic", "n_chars"), 9)


@query(
    "l12_confusion",
    """
    with s as (select quality as y, n_chars > 500 as p from documents join labels using (doc_id)),
    c as (select count_if(y = 1 and p)::bigint as tp, count_if(y = 0 and p)::bigint as fp, count_if(y = 1 and not p)::bigint as fn,
      count_if(y = 0 and not p)::bigint as tn from s)
    select *, round((tp + tn) / (tp + fp + fn + tn), 9) as accuracy, round(tp / (tp + fn), 9) as recall, round(tp / (tp + fp), 9) as precision from c
    """,
)
def l12_confusion(t: Tables):
    rows = t.documents.join(t.labels, "doc_id").select("quality", (F.col("n_chars") > 500).cast("int").alias("prediction"))
    return rounded(classify.confusion(rows, "quality"), 9)


@query("l12_score_on_test")
def l12_test(t: Tables):
    scored = _fit_and_score(t, classify.tree_classifier(4), "none")
    return rounded(classify.auc_rank(scored, "label", "score"), 3)


@query("l12_stump_on_test", f"with {STUMP}, ranked as (select *, {RANK.format(part='1').replace('order by s)', 'order by score)').replace('1, s)', '1, score)')} from s) select round({AUC}, 9) as auc from ranked")
def l12_stump(t: Tables):
    """ROC-AUC on the test part of a tree that one cut describes."""
    train, test = _stump_table(t)
    model = features.build_pipeline([], {}, ["x"], classify.tree_classifier(1), "none").fit(train)
    return rounded(classify.auc_rank(classify.score(model, test, ["label"]), "label", "score"), 9)


LOGITS = """
    d as (select doc_id, 'k' || doc_id % 3 as kind, quality as y from documents join labels using (doc_id)),
    m as (select kind, avg(y) as p from d group by kind), z as (select ln(p / (1 - p)) as a from m order by kind limit 1),
    w as (select kind, ln(p / (1 - p)) - a as w, row_number() over (order by kind) - 2 as feature from m, z)
"""


@query(
    "l13_linear_attribution",
    f"""
    with {LOGITS}, s as (select kind, count(*)::double / (select count(*) from d) as mean from d group by kind)
    select doc_id, feature::int as feature, abs(round(w * ((d.kind = w.kind)::int - mean), 2)) as phi from d, w join s on s.kind = w.kind where feature >= 0
    """,
)
def l13_linear(t: Tables):
    """With one category and no penalty, weights are differences of the groups' log-odds; rounded to what the fit converges to."""
    kind = F.concat(F.lit("k"), F.col("doc_id") % 3).alias("kind")
    rows = written(examples(t).select("doc_id", kind, "label"), "examples")
    data = features.build_pipeline(["kind"], {}, [], None).fit(rows).transform(rows)
    model = classify.logistic().fit(packed(data))
    phi = attribution.linear_attribution(model, data, "doc_id", data)
    return phi.select("doc_id", "feature", F.abs(F.round("phi", 2)).alias("phi"))


@query(
    "l13_tree_attribution",
    f"""
    with {STUMP}, z as (select avg(case when same then p / n when x <= cut then pl / nl else (p - pl) / (n - nl) end) as base from d, b where not test)
    select doc_id, 0::int as feature, abs(round(score - base, 9)) as phi from s, z
    """,
)
def l13_tree(t: Tables):
    """A tree of one cut: its only feature carries the whole change of the score."""
    train, test = _stump_table(t)
    prep = features.build_pipeline([], {}, ["x"], None, "none").fit(train)
    model = classify.tree_classifier(1).fit(prep.transform(train))
    phi = attribution.tree_attribution(model, prep.transform(test), "doc_id", 1, prep.transform(train))
    return phi.select("doc_id", "feature", F.abs(F.round("phi", 9)).alias("phi"))


@query(
    "l13_permutation_importance_of_one_cut",
    f"""
    with {STUMP}, h as (select doc_id, y, score, ('0x' || substr(md5(doc_id::varchar || ':42'), 1, 13))::bigint as h1,
        ('0x' || substr(md5(doc_id::varchar || ':43'), 1, 13))::bigint as h2 from s),
    k as (select *, row_number() over (order by h1, h2) as take, row_number() over (order by h2, h1) as give from h),
    a as (select a.y, a.score as own, b.score as other from k a join k b on a.take = b.give),
    whole as (select {AUC} as auc from (select y, rank() over (order by own) + (count(*) over (partition by own) - 1) / 2 as r from a)),
    mixed as (select {AUC} as auc from (select y, rank() over (order by other) + (count(*) over (partition by other) - 1) / 2 as r from a))
    select 'x' as feature, abs(round(whole.auc - mixed.auc, 9)) as loss from whole, mixed
    """,
)
def l13_cut_importance(t: Tables):
    train, test = _stump_table(t)
    prep = features.build_pipeline([], {}, ["x"], None, "none").fit(train)
    model = classify.tree_classifier(1).fit(prep.transform(train))
    out = attribution.permutation_importance(model, prep.transform(test), "doc_id", "label", ["x"])
    return out.select("feature", F.abs(F.round("loss", 9)).alias("loss"))


@query("l13_attribution")
def l13(t: Tables):
    train, test = split_examples(t)
    prep = features.build_pipeline([], {}, NUM, None, "standard").fit(train)
    model = classify.logistic(penalty=0.01).fit(prep.transform(train))
    base = attribution.background(prep.transform(train), "doc_id")
    phi = attribution.attribution(model, prep.transform(test), "doc_id", len(NUM), base)
    return rounded(attribution.mean_attribution(phi, NUM), 3)


@query("l13_attribution_sums", "select doc_id, 0.0::double as gap from documents join labels using (doc_id)")
def l13_sums(t: Tables):
    """A row's values add up to its score less the mean score of the background."""
    rows = written(examples(t), "examples")
    data = features.build_pipeline([], {}, NUM, None, "standard").fit(rows).transform(rows)
    model = classify.logistic(penalty=0.01).fit(data)
    base = written(attribution.background(data, "doc_id", 10).select("doc_id", "features"), "background")
    phi = attribution.attribution(model, data.select("doc_id", "features"), "doc_id", len(NUM), base, n_perm=2)
    total = phi.groupBy("doc_id").agg(F.sum("phi").alias("total"))
    start = classify.score(model, base, ["doc_id"]).agg(F.avg("score").alias("start"))
    both = attach(total.join(classify.score(model, data, ["doc_id"]), "doc_id"), start)
    return both.select("doc_id", F.abs(F.round(F.col("total") - F.col("score") + F.col("start"), 6)).alias("gap"))


@query("l13_permutation_importance")
def l13_cheap(t: Tables):
    train, test = split_examples(t)
    prep = features.build_pipeline([], {}, NUM, None, "standard").fit(train)
    model = classify.logistic(penalty=0.01).fit(prep.transform(train))
    return rounded(attribution.permutation_importance(model, prep.transform(test), "doc_id", "label", NUM), 3)


@query(
    "l14_risk_segment",
    """
    with s as (select doc_id, toxic, n_chars, sum(n_chars) over (order by n_chars desc, doc_id rows unbounded preceding) / sum(n_chars) over () as share
      from documents join labels using (doc_id))
    select doc_id, n_chars, round(share, 9) as share from s where share <= 0.8 and toxic = 1
    """,
)
def l14(t: Tables):
    pred = t.labels.select("doc_id", F.col("toxic").cast("double").alias("prediction"))
    out = classify.risk_segment(pred, t.documents, "doc_id", "n_chars")
    return rounded(out.select("doc_id", "n_chars", "share"), 9)
