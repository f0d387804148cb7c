"""Queries of vector and score arithmetic over embeddings, and of balanced assignment over events.

A label's vectors stand for a question's candidates; the one of smallest id is the answer.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions import text as X
from ..functions import vector as V
from ..operators import choices as C
from ..operators import questions as Q
from ..operators.projection import projected
from .base import ORACLES, query, sql_cosine, sql_hash, table

_POOL = """
e AS (SELECT label AS qid, vec_id AS i, embedding AS v FROM embeddings),
a AS (SELECT qid, arg_min(v, i) AS av FROM e GROUP BY qid)"""


def pool(spark, sf_dir):
    """qid, i, embedding: the vectors as the candidate pools of their labels."""
    return table(spark, sf_dir, "embeddings").select(F.col("label").alias("qid"), F.col("vec_id").alias("i"), "embedding")


def scored(spark, sf_dir, with_answer: bool = True):
    """pool with answer (its embedding), sim (to the answer), p_sentence, p_passage and ctx; the answer is a candidate as
    in the SQL, or none."""
    rows = pool(spark, sf_dir)
    answers = rows.groupBy("qid").agg(F.min(F.struct("i", "embedding")).alias("a")).select("qid", F.col("a.i").alias("answer_i"), F.col("a.embedding").alias("answer"))
    p_sentence, p_passage = (F.col("i") % 97 + 1) / 100.0, (F.col("i") % 89 + 1) / 90.0
    # Native scores first; a label's extremes are a grouped sum that is joined again, so no window holds its vectors.
    rows = rows.join(answers, "qid").where(F.lit(with_answer) | (F.col("i") != F.col("answer_i"))).withColumns({"cos": V.cosine("embedding", "answer"), "p_sentence": p_sentence, "p_passage": p_passage, "raw": V.context_score(p_sentence, p_passage, 0.4)})
    edges = rows.groupBy("qid").agg(F.min("raw").alias("low"), F.max("raw").alias("high"), F.min("cos").alias("least"), F.max("cos").alias("most"))
    rows = rows.join(edges, "qid").withColumns({"ctx": V.min_max(F.col("raw"), F.col("low"), F.col("high")), "sim": V.min_max(F.col("cos"), F.col("least"), F.col("most"))})
    return rows.select("qid", "i", "embedding", "cos", "p_sentence", "p_passage", "raw", "ctx", "sim", "answer")


_SCORED = f"""{_POOL},
c AS (SELECT e.qid, i, v, {sql_cosine("v", "av")} AS cos, (i % 97 + 1) / 100.0 AS p_sentence, (i % 89 + 1) / 90.0 AS p_passage FROM e JOIN a USING (qid)),
r AS (SELECT *, ln(greatest(p_sentence, 1e-10)) - 0.4 * ln(greatest(p_passage, 1e-10)) AS raw FROM c),
s AS (SELECT *, (raw - min(raw) OVER w) / (max(raw) OVER w - min(raw) OVER w + 1e-10) AS ctx, (cos - min(cos) OVER w) / (max(cos) OVER w - min(cos) OVER w + 1e-10) AS sim FROM r WINDOW w AS (PARTITION BY qid))"""


@query(f"WITH {_POOL} SELECT e.qid, i, round({sql_cosine('v', 'av')}, 6) AS cosine FROM e JOIN a USING (qid)")
def cosine_to_answer(spark, sf_dir):
    return scored(spark, sf_dir).select("qid", "i", F.round("cos", 6).alias("cosine"))


@query(f"WITH {_POOL} SELECT x.qid, x.i, y.i AS j, round(1 - {sql_cosine('x.v', 'y.v')}, 6) AS distance FROM e x JOIN e y ON x.qid = y.qid AND x.i < y.i")
def pairwise_distance(spark, sf_dir):
    return C.all_pair_distances(pool(spark, sf_dir)).withColumn("distance", V.rounded("distance", 6))


@query(f"WITH {_POOL} SELECT x.qid, x.i, round(avg(1 - {sql_cosine('x.v', 'y.v')}), 6) AS diversity FROM e x JOIN e y ON x.qid = y.qid GROUP BY x.qid, x.i")
def diversity(spark, sf_dir):
    return C.diversity(pool(spark, sf_dir)).withColumn("diversity", F.round("diversity", 6))


@query(f"""WITH {_SCORED} SELECT qid, i, round(raw, 6) AS raw, round(ctx, 6) AS ctx, round(sim, 6) AS sim, round(exp((ln(p_sentence) + ln(p_passage)) / 2), 6) AS geometric,
 round(1 / (1 + exp(-raw)), 6) AS squashed FROM s""")
def context_scores(spark, sf_dir):
    rows = scored(spark, sf_dir)
    return rows.select("qid", "i", F.round("raw", 6).alias("raw"), F.round("ctx", 6).alias("ctx"), F.round("sim", 6).alias("sim"), F.round(V.geometric_mean(F.col("p_sentence"), F.col("p_passage")), 6).alias("geometric"), F.round(V.sigmoid(F.col("raw")), 6).alias("squashed"))


_CHOSEN = "k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY raw DESC, i) AS rk FROM s) WHERE rk <= 4)"


def _chosen(spark, sf_dir, with_answer: bool = True):
    best = Window.partitionBy("qid").orderBy(F.desc("raw"), "i")
    return scored(spark, sf_dir, with_answer).withColumn("rk", F.row_number().over(best)).where("rk <= 4")


#: The answer is no candidate, and ctx and sim are scaled over the candidates alone.
_CANDIDATES = _SCORED.replace("FROM e JOIN a USING (qid))", "FROM e JOIN a USING (qid) WHERE i <> ai)").replace("arg_min(v, i) AS av", "arg_min(v, i) AS av, min(i) AS ai")
_FAR = "CASE WHEN 1 - {0} < 1e-12 THEN 0 ELSE 1 - {0} END"


@query(f"""WITH {_CANDIDATES}, {_CHOSEN}, d AS (SELECT x.qid, 1 - {sql_cosine("x.v", "y.v")} AS d FROM k x JOIN k y ON x.qid = y.qid AND x.i < y.i UNION ALL SELECT qid, 1 - cos FROM k),
p AS (SELECT qid, CASE WHEN count(*) FILTER (WHERE d = 0) > 0 THEN 0 ELSE count(*) / sum(1 / nullif(d, 0)) END AS e_emb FROM d GROUP BY qid),
q AS (SELECT qid, sum(ctx) AS e_ctx, CASE WHEN count(*) FILTER (WHERE sim = 0) > 0 THEN 0 ELSE count(*) / sum(1 / nullif(sim, 0)) END AS e_sim FROM k GROUP BY qid)
SELECT qid, round(e_ctx, 6) AS e_ctx, round(e_sim, 6) AS e_sim, round(coalesce(e_emb, 0), 6) AS e_emb, round(e_ctx + 0.3 * coalesce(e_emb, 0) - 0.4 * e_sim, 6) AS objective FROM q LEFT JOIN p USING (qid)""")
def energy(spark, sf_dir):
    """The energy of the four best candidates a question: the answer is a member of the pairs and no candidate."""
    return C.energy(_chosen(spark, sf_dir, False)).select("qid", *[F.round(c, 6).alias(c) for c in ("e_ctx", "e_sim", "e_emb", "objective")])


@query(ORACLES["energy"])
def energy_to_answer(spark, sf_dir):
    """As energy, by the name under which the selections were held against it."""
    return energy(spark, sf_dir)


@query(f"""WITH {_SCORED}, {_CHOSEN}, d AS (SELECT x.qid, sum(1 - {sql_cosine("x.v", "y.v")}) AS delta FROM k x JOIN k y ON x.qid = y.qid AND x.i < y.i GROUP BY x.qid),
m AS (SELECT qid, ln(avg(p_sentence)) AS phi, -ln(avg(p_passage)) AS capital_phi FROM k GROUP BY qid)
SELECT qid, round(phi, 6) AS phi, round(capital_phi, 6) AS capital_phi, round(coalesce(delta, 0), 6) AS delta FROM m LEFT JOIN d USING (qid)""")
def set_quality(spark, sf_dir):
    return C.set_quality(_chosen(spark, sf_dir)).select("qid", *[F.round(c, 6).alias(c) for c in ("phi", "capital_phi", "delta")])


@query(f"WITH {_SCORED} SELECT qid, i, round(raw, 6) AS score, CAST(rk AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY raw DESC, CAST(i AS VARCHAR)) AS rk FROM s) WHERE rk <= 5")
def pool_rank(spark, sf_dir):
    ranked = C.pool(scored(spark, sf_dir).withColumn("word", F.col("i").cast("string")), 5)
    return ranked.select("qid", "i", F.round("score", 6).alias("score"), "rank")


@query(f"""WITH {_SCORED}, f AS (SELECT qid, i, raw AS score, cos AS word_sim, ctx AS sentence_sim, i % 2 = 0 AS same_tag FROM s),
t AS (SELECT qid, i, 0.6 * CASE WHEN max(score) OVER w = min(score) OVER w THEN 0 ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END
 + 0.15 * (1 - CASE WHEN max(word_sim) OVER w = min(word_sim) OVER w THEN 0 ELSE (word_sim - min(word_sim) OVER w) / (max(word_sim) OVER w - min(word_sim) OVER w) END)
 + 0.15 * (1 - CASE WHEN max(sentence_sim) OVER w = min(sentence_sim) OVER w THEN 0 ELSE (sentence_sim - min(sentence_sim) OVER w) / (max(sentence_sim) OVER w - min(sentence_sim) OVER w) END)
 + 0.1 * CAST(same_tag AS INTEGER) AS total FROM f WINDOW w AS (PARTITION BY qid))
SELECT qid, i, CAST(rk AS INTEGER) AS rank, round(total, 6) AS total FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(total, 9) DESC, i) AS rk FROM t) WHERE rk <= 3""")
def weighted_rank(spark, sf_dir):
    rows = scored(spark, sf_dir).select("qid", "i", F.col("raw").alias("score"), F.col("cos").alias("word_sim"), F.col("ctx").alias("sentence_sim"), (F.col("i") % 2 == 0).alias("same_tag"))
    return C.weighted_rank(rows).select("qid", "i", "rank", F.round("total", 6).alias("total"))


@query()
def principal_components(spark, sf_dir):
    """Every embedding on the two axes of largest variance. SQL has no eigenvectors; a test holds it against a plain
    singular value decomposition."""
    rows = projected(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"), "embedding")
    return rows.select("vec_id", "label", F.round("pc1", 6).alias("pc1"), F.round("pc2", 6).alias("pc2"))


@query("""WITH x AS (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) SELECT label, round(var_pop(x), 6) AS entropy, round(var_samp(x), 6) AS variance, var_samp(x) <= 0.5 AS coherent FROM x GROUP BY label""")
def type_entropy(spark, sf_dir):
    x = table(spark, sf_dir, "embeddings").select("label", F.explode(V.doubles("embedding")).alias("x"))
    return x.groupBy("label").agg(F.round(F.var_pop("x"), 6).alias("entropy"), F.round(F.var_samp("x"), 6).alias("variance"), Q.coherence_gate(F.var_samp("x")).alias("coherent"))


@query("""WITH x AS (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(1, len(embedding) + 1)) AS d FROM embeddings) SELECT label, d, round(avg(x), 6) AS mean FROM x GROUP BY label, d""")
def mean_pooling(spark, sf_dir):
    x = table(spark, sf_dir, "embeddings").select("label", F.posexplode(V.doubles("embedding")).alias("p", "x"))
    return x.groupBy("label", (F.col("p") + 1).cast("long").alias("d")).agg(F.round(F.avg("x"), 6).alias("mean"))


@query("""WITH r AS (SELECT user_id AS id, event_id % 3 AS position, value / 100 AS ratio FROM events),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, position ORDER BY ratio DESC) AS k FROM r) WHERE k <= 4) SELECT id, position, round(1 / (1 + exp(-sum(ratio) / 1000)), 9) AS score FROM k GROUP BY id, position""")
def position_scores(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), (F.col("event_id") % 3).alias("position"), (F.col("value") / 100).alias("ratio"))
    return C.position_scores(rows, 4).withColumn("score", F.round("score", 9))


@query("""WITH m AS (SELECT event_id, user_id, value / 100 - max(value / 100) OVER (PARTITION BY user_id) AS x FROM events)
SELECT event_id, round(exp(x) / sum(exp(x)) OVER (PARTITION BY user_id), 9) AS p FROM m""")
def softmax(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", (F.col("value") / 100).alias("x"))
    return C.softmax(rows, ["user_id"], "x").select("event_id", F.round("p", 9).alias("p"))


@query("""WITH w AS (SELECT user_id, avg(ln(value + 1)) AS m, count(*) AS n, count(*) / sum(1 / nullif(value + 1, 0)) AS h FROM events GROUP BY user_id) SELECT user_id, round(exp(m), 6) AS mean_probability, round(h, 6) AS harmonic FROM w""")
def log_means(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("v", F.col("value") + 1)
    return rows.groupBy("user_id").agg(F.round(F.exp(F.avg(F.log("v"))), 6).alias("mean_probability"), F.round(V.harmonic_mean(F.col("v")), 6).alias("harmonic"))


@query()
def anneal_select(spark, sf_dir):
    """The annealed choice is random by nature (seeded); tests hold it against the exact one."""
    return C.select_candidates(scored(spark, sf_dir, False), k=3)


@query(f"""WITH {_CANDIDATES}, u AS (SELECT x.qid, x.i, y.i AS j, {_FAR.format(sql_cosine("x.v", "y.v"))} AS d FROM s x JOIN s y ON x.qid = y.qid AND x.i < y.i),
n AS (SELECT qid, i, ctx, sim, {_FAR.format("cos")} AS d, row_number() OVER (PARTITION BY qid ORDER BY i) AS place FROM s),
t AS (SELECT a.qid, [a.i, b.i, c.i] AS chosen, a.ctx + b.ctx + c.ctx AS e_ctx, CASE WHEN least(a.sim, b.sim, c.sim) = 0 THEN 0 ELSE 3 / (1 / a.sim + 1 / b.sim + 1 / c.sim) END AS e_sim,
 CASE WHEN least(ab.d, ac.d, bc.d, a.d, b.d, c.d) = 0 THEN 0 ELSE 6 / (1 / ab.d + 1 / ac.d + 1 / bc.d + 1 / a.d + 1 / b.d + 1 / c.d) END AS e_emb
 FROM n a JOIN n b ON a.qid = b.qid AND a.place < b.place JOIN n c ON b.qid = c.qid AND b.place < c.place JOIN u ab ON ab.qid = a.qid AND ab.i = a.i AND ab.j = b.i JOIN u ac ON ac.qid = a.qid AND ac.i = a.i AND ac.j = c.i JOIN u bc ON bc.qid = a.qid AND bc.i = b.i AND bc.j = c.i),
best AS (SELECT qid, arg_min(chosen, (-round(e_ctx + 0.3 * e_emb - 0.4 * e_sim, 12), chosen)) AS chosen FROM t GROUP BY qid)
SELECT qid, CAST(unnest(range(1, 4)) AS INTEGER) AS slot, unnest(chosen) AS i FROM best""")
def exact_select(spark, sf_dir):
    return C.select_candidates(scored(spark, sf_dir, False), k=3, exact=True)


#: events as an arrival stream: the five event types in alphabetical order are the five categories.
_RANK = "(SELECT count(DISTINCT event_type) FROM events t WHERE t.event_type < e.event_type)"


@query("""WITH d AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) - 1 AS seen FROM events) SELECT event_id, CAST(seen AS BIGINT) AS seen FROM d""")
def balance_counts(spark, sf_dir):
    w = Window.partitionBy("user_id", "event_type").orderBy("event_id").rowsBetween(Window.unboundedPreceding, -1)
    return table(spark, sf_dir, "events").select("event_id", F.count("*").over(w).alias("seen"))


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), m AS (SELECT user_id, max(n) AS most FROM c GROUP BY user_id)
SELECT user_id, event_type, round(1 + (most - n) / CAST(greatest(10, most) AS DOUBLE), 6) AS discount FROM c JOIN m USING (user_id)""")
def balance_discount(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    kinds = [r["event_type"] for r in events.select("event_type").distinct().orderBy("event_type").collect()]  # five
    counts = events.groupBy("user_id").agg(*[F.count_if(F.col("event_type") == k).alias(k) for k in kinds])
    factors = Q.discounts({k: F.col(k) for k in kinds})
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("event_type"), F.col(k).alias("n"), F.round(f, 6).alias("discount")) for k, f in factors.items()]))
    return counts.select("user_id", each.alias("d")).where("d.n > 0").select("user_id", "d.event_type", "d.discount")


def arrivals_of(events):
    """Scores of the seven types, and draws, for each event; users are scopes, in order of event_id."""
    e = events.select((F.col("user_id") % 50).alias("scope"), "event_id")
    base = {t: (X.hashed(t, "event_id") % 6).cast("double") for t in L.CATEGORIES}
    scores = base | {"short_inverse": base["short"], "multi_hop_inverse": base["multi_hop"]}
    return e.select("scope", "event_id", *[scores[t].alias(f"score_{t}") for t in L.TYPES], X.hashed("draw", "event_id").alias("draw"), X.hashed("flip", "event_id").alias("flip"))


_N = {c: f"n_{c}" for c in L.CATEGORIES}
_MOST = "greatest(" + ", ".join(_N.values()) + ")"
_LAG = {c: f"({_MOST} - {n} >= 10)" for c, n in _N.items()}
_SCALE = f"greatest(10, {_MOST})"
_ADJUSTED = {t: f"(s_{L.CATEGORY[t]} * ({_SCALE} + {_MOST} - {_N[L.CATEGORY[t]]}))" for t in L.TYPES}
_TOP = "greatest(" + ", ".join(_ADJUSTED.values()) + ")"
_FREE = "CASE " + " ".join(f"WHEN {_ADJUSTED[t]} = {_TOP} THEN '{t}'" for t in L.TYPES) + " END"
_ELIGIBLE = "list_filter([" + ", ".join(f"CASE WHEN {_LAG[L.CATEGORY[t]]} THEN '{t}' END" for t in L.TYPES) + "], lambda v: v IS NOT NULL)"
_CHOICE = f"CASE WHEN {' OR '.join(_LAG.values())} THEN ({_ELIGIBLE})[1 + draw % len({_ELIGIBLE})] ELSE {_FREE} END"
_COUNTED = ", ".join(f"{n} + CAST(chosen IN ({', '.join(repr(t) for t in L.TYPES if L.CATEGORY[t] == c)}) AS INTEGER) AS {n}" for c, n in _N.items())


@query(f"""WITH RECURSIVE r AS (SELECT user_id % 50 AS scope, event_id, row_number() OVER (PARTITION BY user_id % 50 ORDER BY event_id) AS k, {", ".join(f"{sql_hash(c, 'event_id')} % 6 AS s_{c}" for c in L.CATEGORIES)},
 {sql_hash("draw", "event_id")} AS draw, {sql_hash("flip", "event_id")} % 2 AS flip FROM events),
f AS (SELECT scope, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS VARCHAR) AS assigned, {", ".join(f"0 AS {n}" for n in _N.values())} FROM (SELECT DISTINCT scope FROM r)
 UNION ALL SELECT scope, k, event_id, chosen || CASE WHEN chosen IN ('short', 'multi_hop') AND flip = 0 THEN '_inverse' ELSE '' END, {_COUNTED}
 FROM (SELECT r.scope, r.k, r.event_id, r.flip, {", ".join("f." + n for n in _N.values())}, {_CHOICE} AS chosen FROM f JOIN r ON r.scope = f.scope AND r.k = f.k + 1))
SELECT scope, event_id, assigned FROM f WHERE k > 0""")
def balance_fold(spark, sf_dir):
    return Q.balanced(arrivals_of(table(spark, sf_dir, "events")), ["scope"], ["event_id"]).select("scope", "event_id", "assigned")
