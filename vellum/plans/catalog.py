"""Every query of the core with its SQL, by name.  All of them run over whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import language as L
from ..functions import text as X
from ..operators import decontaminate, dedup, filters, formatters, inference, repair, routing, stats, token_files
from ..operators.components import connected_components
from ..session import materialize, spread
from ..streaming import rate_windows
from . import sql as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "documents").where(F.length("text") > 0)


def _filter_sql(case: str, prep: str = "text") -> str:
    return f"WITH {S.DOCS}, p AS (SELECT doc_id, {prep} FROM docs) SELECT doc_id, {case} AS filter_reason FROM p"


def _case(*rules: tuple[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {t} THEN {S.q(n)}" for t, n in rules) + " END"


def _judged(spark: SparkSession, d: str, reason) -> DataFrame:
    return spread(_docs(spark, d).select("doc_id", "text")).select("doc_id", reason(F.col("text")).cast("string").alias("filter_reason"))


def _t():
    return F.col("text")


# -- sources and routing ---------------------------------------------------------------------------

_META = "metadata.ihb_source_relpath"


@query(f"""
WITH {S.DOCS} SELECT doc_id, coalesce(id, concat_ws('/', {_META}, metadata.ihb_source_line::VARCHAR)) AS id, length(text)::BIGINT AS chars FROM docs""")
def read_adapter(spark, d):
    docs = _table(spark, d, "documents")
    out = routing.adapt(docs, path=F.col(_META), row=F.col("metadata.ihb_source_line"))
    key = F.get_json_object("metadata", "$.doc_id").cast("long")
    return out.select(key.alias("doc_id"), "id", F.length("text").cast("long").alias("chars"))


@query("SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 50 OFFSET 10")
def read_skip_limit(spark, d):
    return routing.skip_limit(_table(spark, d, "documents").select("doc_id", "lang", "source"), "doc_id", 10, 50)


@query("SELECT doc_id, text FROM documents")
def read_parquet_pruned(spark, d):
    return _table(spark, d, "documents").select("doc_id", "text")


_RECORD_REASON = """
WITH j AS (SELECT record_id, raw, ihb_source_relpath, CASE WHEN json_valid(raw) THEN raw::JSON END AS v FROM records),
r AS (SELECT record_id, ihb_source_relpath, raw, v, CASE WHEN v IS NULL THEN 'invalid_json' WHEN json_type(v) <> 'OBJECT' THEN 'invalid_record'
 WHEN coalesce(json_type(v, '$.text'), '') <> 'VARCHAR' OR NOT regexp_matches(v->>'text', '[^\\s]') THEN 'missing_text' END AS reason FROM j)
"""


@query(_RECORD_REASON + "SELECT record_id, reason, length(CASE WHEN reason IN ('invalid_json', 'invalid_record') THEN raw ELSE v->>'text' END)::BIGINT AS chars FROM r")
def input_validation(spark, d):
    out = routing.validate_lines(_table(spark, d, "records"))
    return out.select("record_id", "reason", F.length("text").cast("long").alias("chars"))


@query(_RECORD_REASON + "SELECT ihb_source_relpath AS source, CASE WHEN reason IS NULL THEN 'survive' ELSE 'eliminated' END AS category, reason, count(*) AS n FROM r GROUP BY ALL")
def route_survive_eliminated(spark, d):
    v = routing.validate_lines(_table(spark, d, "records"))
    routed = routing.route(v.where("reason is null"), v.where("reason is not null"))
    return routed.groupBy(F.col("ihb_source_relpath").alias("source"), "category", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(_RECORD_REASON + "SELECT count(*) AS input, count(*) FILTER (WHERE reason IS NULL) AS survive, count(reason) AS eliminated, true AS balanced FROM r")
def routing_balance(spark, d):
    v = routing.validate_lines(_table(spark, d, "records"))
    return routing.balance(routing.route(v.where("reason is null"), v.where("reason is not null")))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT min(doc_id) FROM documents WHERE text IS NOT NULL GROUP BY text)")
def route_dropped(spark, d):
    docs = _table(spark, d, "documents")
    after = docs.where("text is not null").groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    return routing.dropped_between(docs.select("doc_id"), after, "doc_id")


@query("SELECT 'document' AS kind, doc_id AS id, lang, NULL::VARCHAR AS task FROM documents UNION ALL SELECT 'item', item_id, NULL, task FROM benchmark")
def union_sources(spark, d):
    a = _table(spark, d, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "lang")
    b = _table(spark, d, "benchmark").select(F.lit("item").alias("kind"), F.col("item_id").alias("id"), "task")
    return routing.union_all(a, b)


# -- filters --------------------------------------------------------------------------------------


@query(_filter_sql(_case(("NOT coalesce(length(text) > 1000 AND lang = 'en', false)", "lambda")), "text, lang"))
def filter_lambda(spark, d):
    return _docs(spark, d).select("doc_id", filters.keep_if((F.length("text") > 1000) & (F.col("lang") == "en")).alias("filter_reason"))


@query(_filter_sql(_case(("regexp_matches(text, 'harvest|Ernte|cosecha')", "regex"))))
def filter_regex(spark, d):
    return _judged(spark, d, lambda t: filters.regex("harvest|Ernte|cosecha", t))


_U = f"((({S.sha1_64('doc_id::VARCHAR || chr(1) || 0::VARCHAR')})::HUGEINT % 9007199254740992 + 9007199254740992) % 9007199254740992)::DOUBLE / 9007199254740992"


@query(f"WITH {S.DOCS} SELECT doc_id, CASE WHEN {_U} >= 0.5 THEN 'sampled_out' END AS filter_reason FROM docs")
def filter_sampler(spark, d):
    return _docs(spark, d).select("doc_id", filters.sampler(0.5, F.col("doc_id")).alias("filter_reason"))


_LONG = f"list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace({S.strip('x')}, {S.q(S.WS + '+')}, ' ', 'g')), lambda x: length(x) >= 120)"


@query(_filter_sql(_case((f"{S.strip('text')} = ''", "empty_text"), (f"{S.dup_c('shown')} > 0.8 * length(text)", "extreme_repeated_lines")), f"text, {_LONG} AS shown"))
def filter_book_quality(spark, d):
    return _judged(spark, d, filters.book_quality)


_STOPS = "[" + ", ".join(S.q(w) for w in filters.STOP_WORDS) + "]"
_BULLETS = f"^{S.WS}*[•\\-]"
_ELLIPSIS = f"(\\.\\.\\.|…){S.WS}*\\z"


@query(
    f"""WITH {S.DOCS}, w AS (SELECT doc_id, text, {S.words('text')} AS w, {S.split_lines('text')} AS l FROM docs),
p AS (SELECT *, len(w) AS n FROM w)
SELECT doc_id, CASE WHEN n < 50 THEN 'gopher_short_doc' WHEN n > 100000 THEN 'gopher_long_doc'
 WHEN {S.total('w')} / n < 3 THEN 'gopher_below_avg_threshold' WHEN {S.total('w')} / n > 10 THEN 'gopher_above_avg_threshold'
 WHEN (length(text) - length(replace(text, '#', ''))) / n > 0.1 THEN 'gopher_too_many_hashes'
 WHEN ((length(text) - length(replace(text, '...', ''))) / 3 + length(text) - length(replace(text, '…', ''))) / n > 0.1 THEN 'gopher_too_many_ellipsis'
 WHEN len(list_filter(l, lambda x: regexp_matches(x, {S.q(_BULLETS)}))) / len(l) > 0.95 THEN 'gopher_too_many_bullets'
 WHEN len(list_filter(l, lambda x: regexp_matches(x, {S.q(_ELLIPSIS)}))) / len(l) > 0.75 THEN 'gopher_too_many_end_ellipsis'
 WHEN len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}'))) / n < 0.5 THEN 'gopher_below_alpha_threshold'
 WHEN len(list_intersect(w, {_STOPS})) < 2 THEN 'gopher_enough_stop_words' END AS filter_reason FROM p"""
)
def filter_gopher_quality(spark, d):
    return _judged(spark, d, filters.gopher_quality)


_PARAS = f"regexp_split_to_array({S.strip('text')}, '\\n{{2,}}')"
_LINES = "regexp_split_to_array(text, '\\n+')"


@query(
    f"""WITH {S.DOCS}, p AS (SELECT doc_id, text, {_PARAS} AS p, {_LINES} AS l FROM docs)
SELECT doc_id, CASE WHEN {S.dup_n('p')} / len(p) > 0.3 THEN 'dup_para_frac' WHEN {S.dup_c('p')} / length(text) > 0.2 THEN 'dup_para_char_frac'
 WHEN {S.dup_n('l')} / len(l) > 0.3 THEN 'dup_line_frac' WHEN {S.dup_c('l')} / length(text) > 0.2 THEN 'dup_line_char_frac' END AS filter_reason FROM p"""
)
def filter_repeated_lines(spark, d):
    return _judged(spark, d, filters.repeated_lines)


@query()
def filter_gopher_repetition(spark, d):
    return _judged(spark, d, filters.gopher_repetition)


_C4 = f"""WITH {S.DOCS}, l AS (SELECT doc_id, generate_subscripts({S.split_lines('text')}, 1) AS i, unnest({S.split_lines('text')}) AS raw FROM docs),
s AS (SELECT doc_id, i, {S.strip('raw')} AS line FROM l),
c AS (SELECT *, regexp_replace(line, '\\[\\d*\\]|\\[edit\\]|\\[citation needed\\]', '', 'g') AS clean,
 len(list_filter(regexp_split_to_array(line, {S.q(S.WS + '+')}), lambda w: w <> '')) AS n FROM s),
v AS (SELECT doc_id, i, clean, CASE WHEN len(list_filter(regexp_split_to_array(line, {S.q(S.WS + '+')}), lambda w: length(w) > 1000)) > 0 THEN 'too_long_word'
 WHEN NOT regexp_matches(clean, '[.?!"'']\\z') OR clean LIKE '%...' THEN 'no_terminal_punc' WHEN n < 3 THEN 'too_few_words'
 WHEN lower(clean) LIKE '%lorem ipsum%' THEN 'lorem_ipsum' WHEN lower(clean) LIKE '%javascript%' THEN 'javascript' WHEN contains(clean, '{{') THEN 'curly_bracket'
 WHEN regexp_matches(lower(clean), {S.q('|'.join(filters.POLICY))}) THEN 'policy' ELSE 'kept' END AS verdict FROM c),
g AS (SELECT doc_id, min(i) FILTER (WHERE verdict IN ('lorem_ipsum', 'curly_bracket')) AS fatal_at,
 arg_min(verdict, i) FILTER (WHERE verdict IN ('lorem_ipsum', 'curly_bracket')) AS fatal,
 coalesce(sum(len({S.sentences('clean')})) FILTER (WHERE verdict = 'kept'), 0) AS n,
 coalesce(string_agg(clean, chr(10) ORDER BY i) FILTER (WHERE verdict = 'kept'), '') AS kept FROM v GROUP BY doc_id)
"""


@query(_C4 + f"SELECT doc_id, CASE WHEN fatal IS NOT NULL THEN fatal WHEN n < 5 THEN 'too_few_sentences' END AS filter_reason, CASE WHEN fatal IS NULL AND n >= 5 THEN length({S.strip('kept')}) ELSE 0 END::BIGINT AS kept_chars FROM g")
def filter_c4_quality(spark, d):
    out = filters.c4_quality(spread(_docs(spark, d).select("doc_id", "text")))
    kept = F.when(F.col("filter_reason").isNull(), F.length("text")).otherwise(0)
    return out.select("doc_id", "filter_reason", kept.cast("long").alias("kept_chars"))


@query(_filter_sql("CASE WHEN NOT coalesce(list_reverse_sort(list_transform(string_split(text, chr(10)), lambda x: length(x)))[3], 0) >= 200 THEN '< 3 paragraphs' END"))
def filter_c4_paragraph(spark, d):
    return _judged(spark, d, filters.c4_paragraph)


@query(_filter_sql(_case(("regexp_matches(lower(text), '(?:[^0-9A-Za-z_]|^)(?:barley|tar)(?:[^0-9A-Za-z_]|$)')", "document_removed_with_badwords_en"))))
def filter_badwords(spark, d):
    return _judged(spark, d, lambda t: filters.bad_words(t, ["tar", "barley"]))


_LISTED = {"en": ("tar", "barley"), "de": ("mühle", "brot"), "zh": ("河",)}


def _listed_sql(lang: str, words: tuple[str, ...]) -> str:
    body = "|".join(words)
    return f"WHEN coalesce(lang, 'en') = '{lang}' AND regexp_matches(lower(text), '{body if lang == 'zh' else f'(?:[^0-9A-Za-z_]|^)(?:{body})(?:[^0-9A-Za-z_]|$)'}') THEN 'document_removed_with_badwords_{lang}'"


@query(_filter_sql("CASE " + " ".join(_listed_sql(k, v) for k, v in _LISTED.items()) + " END", "text, lang"))
def filter_badwords_by_language(spark, d):
    return _docs(spark, d).select("doc_id", filters.bad_words_by_language(_t(), _LISTED, F.col("lang")).alias("filter_reason"))


@query(
    f"""WITH {S.DOCS}, p AS (SELECT doc_id, text, list_filter(string_split(text, chr(10)), lambda x: {S.strip('x')} <> '') AS l, {S.words('text')} AS w FROM docs)
SELECT doc_id, CASE WHEN len(l) = 0 THEN 'empty' WHEN len(list_filter(l, lambda x: regexp_matches(x, {S.q('[.!?' + X.terminal_class() + ']' + chr(92) + 'z')}))) / len(l) < 0.12 THEN 'line_punct_ratio'
 WHEN len(list_filter(l, lambda x: length(x) <= 30)) / len(l) > 0.67 THEN 'short_line_ratio'
 WHEN {S.dup_c('l')} / length(replace(text, chr(10), '')) > 0.01 THEN 'char_dup_ratio'
 WHEN (length(text) - length(replace(text, chr(10), ''))) / greatest(1, len(w)) > 0.3 THEN 'list_ratio' END AS filter_reason FROM p"""
)
def filter_fineweb_quality(spark, d):
    return _judged(spark, d, filters.fineweb_quality)


@query(
    f"""WITH {S.DOCS}, w AS (SELECT doc_id, unnest(list_transform({S.words('text')}, lambda w: lower(w))) AS word FROM docs),
t AS (SELECT word, ln(count(*) / (SELECT count(*) FROM w)) AS logp FROM w GROUP BY word),
s AS (SELECT doc_id, sum(logp) / count(*) AS m FROM w JOIN t USING (word) GROUP BY doc_id)
SELECT d.doc_id, round(coalesce(m, 0.0), 6) AS unigram_logprob, CASE WHEN NOT coalesce(m, 0.0) > -8 THEN 'unigram_logprob' END AS filter_reason FROM docs d LEFT JOIN s USING (doc_id)"""
)
def filter_unigram_logprob(spark, d):
    docs = _docs(spark, d).select("doc_id", "text")
    return filters.unigram_log_prob(docs, filters.unigram_table(docs), threshold=-8)


_URL = f"'https://www.' || coalesce(replace(lower(source), ' ', '-'), 'none') || '.example.com/' || {_META}"


@query(
    f"""WITH u AS (SELECT doc_id, {_URL} AS url FROM documents)
SELECT doc_id, url, CASE WHEN regexp_extract(url, '^https://([^/]+)', 1) = 'www.harbour_archive.example.com' THEN 'subdomain' WHEN regexp_matches(url, '[^a-zA-Z0-9]omnibus[^a-zA-Z0-9]') THEN 'hard_blacklisted'
 WHEN regexp_matches(regexp_replace(lower(url), '[^a-z0-9]', '', 'g'), 'parishvol0') THEN 'blacklisted_subword' END AS filter_reason FROM u"""
)
def filter_url(spark, d):
    url = F.concat(F.lit("https://www."), F.coalesce(F.replace(F.lower("source"), F.lit(" "), F.lit("-")), F.lit("none")), F.lit(".example.com/"), F.col(_META))
    docs = _table(spark, d, "documents").select("doc_id", url.alias("url"))
    reason = filters.url_filter(F.col("url"), domains=["www.harbour_archive.example.com"], banned=["omnibus"], sub=["parishvol0"])
    return docs.withColumn("filter_reason", reason)


@query()
def filter_language(spark, d):
    docs = _docs(spark, d).withColumn("scores", L.language_scores(_t()))
    return docs.select("doc_id", L.best_language(F.col("scores")).alias("language"), F.array_max(F.map_values("scores")).alias("language_score"), filters.language(F.col("scores")).alias("filter_reason"))


@query()
def filter_classifier(spark, d):
    """Labels' quality as a stand-in model: a logistic regression on hashed words of the labelled
    documents (one judgement a document, its latest), applied to every document."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF
    from pyspark.ml.functions import vector_to_array

    docs = _docs(spark, d).select("doc_id", X.words(F.lower("text")).alias("w"))
    latest = _table(spark, d, "labels").groupBy("doc_id").agg(F.max(F.struct("labelled_at", "quality")).alias("m"))
    hashed = HashingTF(numFeatures=4096, inputCol="w", outputCol="features").transform(docs)
    train = hashed.join(latest.select("doc_id", F.col("m.quality").cast("double").alias("label")), "doc_id").where("label is not null")
    model = LogisticRegression(maxIter=10, regParam=0.01).fit(train)
    p = vector_to_array(F.col("probability"))[1]
    return model.transform(hashed).select("doc_id", F.round(p, 4).alias("p_good"), F.when(p < 0.5, "classifier").alias("filter_reason"))


@query(
    f"""WITH {S.DOCS}, p AS (SELECT doc_id, text, {_LONG} AS shown, {S.words('text')} AS w FROM docs)
SELECT CASE WHEN {S.strip('text')} = '' THEN 'empty_text' WHEN {S.dup_c('shown')} > 0.8 * length(text) THEN 'extreme_repeated_lines' WHEN len(w) < 50 THEN 'text_too_short' ELSE 'forwarded' END AS outcome, count(*) AS n FROM p GROUP BY 1"""
)
def filter_funnel(spark, d):
    reason = filters.chain(filters.book_quality(_t()), F.when(F.size(X.words(_t())) < 50, "text_too_short"))
    return stats.funnel(_docs(spark, d), reason)


# -- text functions ----------------------------------------------------------------------------------


@query(f"WITH {S.DOCS} SELECT doc_id, {S.simplify('text')} AS simple FROM docs")
def simplify_text(spark, d):
    return _docs(spark, d).select("doc_id", X.simplify(_t(), marks=False).alias("simple"))


@query(f"WITH {S.DOCS}, w AS (SELECT doc_id, {S.words('text')} AS w FROM docs) SELECT doc_id, len(w)::INT AS n_words, array_to_string(w, ' ') AS words FROM w")
def word_tokenize(spark, d):
    return _docs(spark, d).select("doc_id", X.words(_t()).alias("w")).select("doc_id", F.size("w").alias("n_words"), F.array_join("w", " ").alias("words"))


@query(f"WITH {S.DOCS}, s AS (SELECT doc_id, {S.sentences('text')} AS s FROM docs) SELECT doc_id, len(s)::INT AS n_sentences, array_to_string(s, ' | ') AS sentences FROM s")
def sentence_tokenize(spark, d):
    return _docs(spark, d).select("doc_id", X.sentences(_t()).alias("s")).select("doc_id", F.size("s").alias("n_sentences"), F.array_join("s", " | ").alias("sentences"))


@query(f"WITH {S.DOCS} SELECT doc_id, {S.sha1_64('text')} AS h FROM docs")
def hash_sha1_64(spark, d):
    return _docs(spark, d).select("doc_id", X.sha1_64(_t()).alias("h"))


@query(f"WITH {S.DOCS} SELECT doc_id, ('0x' || substr(sha1(text), 7, 2) || substr(sha1(text), 5, 2) || substr(sha1(text), 3, 2) || substr(sha1(text), 1, 2))::BIGINT AS h FROM docs")
def hash_sha1_32(spark, d):
    return _docs(spark, d).select("doc_id", X.sha1_32(_t()).alias("h"))


@query(f"WITH {S.DOCS}, w AS (SELECT doc_id, {S.words('text')} AS w FROM docs) SELECT doc_id, unnest(range(0, len(w) - 4))::INT AS pos, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS ngram FROM w WHERE len(w) >= 5")
def word_ngrams(spark, d):
    return _docs(spark, d).select("doc_id", F.posexplode(X.ngrams(X.words(_t()), 5)).alias("pos", "ngram"))


# -- deduplication ---------------------------------------------------------------------------------

_EXACT = "WITH k AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY {0} doc_id) AS rn, count(*) OVER (PARTITION BY text) AS n FROM documents WHERE length(text) > 0) "


@query(_EXACT.format("") + "SELECT doc_id, n - 1 AS duplicate_count FROM k WHERE rn = 1")
def dedup_exact(spark, d):
    return dedup.exact_dedup(_docs(spark, d).select("doc_id", "text"), _t()).select("doc_id", "duplicate_count")


@query(_EXACT.format("coalesce(metadata.ihb_source_line, 0) DESC,") + "SELECT doc_id, n - 1 AS duplicate_count FROM k WHERE rn = 1")
def dedup_exact_priority(spark, d):
    docs = _docs(spark, d)
    return dedup.exact_dedup(docs, _t(), priority=F.coalesce("metadata.ihb_source_line", F.lit(0))).select("doc_id", "duplicate_count")


@query("SELECT doc_id FROM documents WHERE length(text) > 0 AND text NOT IN (SELECT text FROM documents WHERE length(text) > 0 AND source = 'harbour_archive')")
def dedup_exact_index(spark, d):
    docs = _docs(spark, d)
    index = dedup.hash_index(docs.where("source = 'harbour_archive'"), _t())
    return dedup.exact_dedup_against(docs, _t(), index).select("doc_id")


_SHINGLES = f"""WITH {S.DOCS}, s AS (SELECT doc_id, list_transform({S.sentences('text')}, lambda x: {S.simplify('x')}) AS s FROM docs),
g AS (SELECT doc_id, unnest(range(0, len(s) - 2))::INT AS sent, unnest(list_transform(range(1, len(s) - 1), lambda i: array_to_string(s[i:i+2], ' '))) AS g FROM s WHERE len(s) >= 3),
h AS (SELECT doc_id, sent, {S.sha1_64('g')} AS h FROM g WHERE {S.strip('g')} <> '')
"""


@query(_SHINGLES + "SELECT doc_id, sent, h FROM h")
def sentence_shingles(spark, d):
    return dedup.sentence_shingles(_docs(spark, d), marks=False)


@query(_SHINGLES + ", r AS (SELECT doc_id, sent, row_number() OVER (PARTITION BY h ORDER BY doc_id, sent) AS rn FROM h) SELECT DISTINCT doc_id, sent FROM r WHERE rn > 1")
def sentence_duplicates(spark, d):
    return dedup.sentence_duplicates(dedup.sentence_shingles(_docs(spark, d), marks=False))


@query()
def dedup_sentence(spark, d):
    docs = _docs(spark, d).select("doc_id", "text")
    shingles = materialize(dedup.sentence_shingles(docs), "shingles")
    out = dedup.sentence_dedup(docs, dedup.sentence_duplicates(shingles), min_words_span=25)
    return out.select("doc_id", "removed", "filter_reason", F.length("text").alias("chars"))


def _signatures(spark, d, marks: bool = False) -> DataFrame:
    return materialize(dedup.minhash_signatures(_docs(spark, d), marks=marks), "signatures")


def _minhash_sql(buckets: int = 14, rows: int = 8) -> str:
    a, b = (x[0].tolist() for x in dedup.permutations(buckets * rows))
    drawn = ", ".join(f"({k}, {x}::HUGEINT, {y}::HUGEINT)" for k, (x, y) in enumerate(zip(a, b)))
    shingle = S.sha1_64_unsigned("g")
    return f"""{S.DOCS}, w AS (SELECT doc_id, {S.words(S.simplify('text'))} AS w FROM docs),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS g FROM w WHERE len(w) >= 5),
x AS (SELECT doc_id, {shingle} AS x FROM s), drawn(k, a, b) AS (VALUES {drawn}),
m AS (SELECT doc_id, k, min((x * a + b) % 18446744073709551616 % {dedup.PRIME}) AS m FROM x CROSS JOIN drawn GROUP BY doc_id, k),
sig AS (SELECT doc_id, (k // {rows})::INT AS band, string_agg(m::VARCHAR, ',' ORDER BY k) AS sig FROM m GROUP BY 1, 2)"""


_SIG = _minhash_sql()
_LINKS = ", f AS (SELECT band, sig, min(doc_id) AS src FROM sig GROUP BY 1, 2), l AS (SELECT DISTINCT src, doc_id AS dst FROM sig JOIN f USING (band, sig) WHERE doc_id <> src)"
_CLUSTERS = """, e AS (SELECT src AS x, dst AS y FROM l UNION SELECT dst, src FROM l),
z AS (SELECT x AS node, x AS met FROM e UNION SELECT z.node, e.y FROM z JOIN e ON e.x = z.met),
c AS (SELECT node AS doc_id, min(met) AS minhash_cluster_id, count(*) AS minhash_cluster_size FROM z GROUP BY node)"""


@query(f"WITH {_SIG} SELECT * FROM sig")
def minhash_signature(spark, d):
    return dedup.minhash_signatures(_docs(spark, d), marks=False).select("doc_id", "band", F.array_join(F.transform("sig", lambda x: x.cast("string")), ",").alias("sig"))


@query(f"WITH {_SIG}{_LINKS} SELECT src, dst FROM l")
def minhash_links(spark, d):
    return dedup.minhash_links(_signatures(spark, d))


@query(f"WITH RECURSIVE {_SIG}{_LINKS}{_CLUSTERS} SELECT * FROM c")
def minhash_clusters(spark, d):
    return dedup.minhash_clusters(_signatures(spark, d))


@query(f"""WITH RECURSIVE {_SIG}{_LINKS}{_CLUSTERS} SELECT doc_id, coalesce(minhash_cluster_id, -1)::BIGINT AS minhash_cluster_id, coalesce(minhash_cluster_size, 1)::BIGINT AS minhash_cluster_size
FROM docs LEFT JOIN c USING (doc_id) WHERE minhash_cluster_id IS NULL OR minhash_cluster_id = doc_id""")
def dedup_minhash(spark, d):
    docs = _docs(spark, d).select("doc_id", "text")
    return dedup.minhash_dedup(docs, dedup.minhash_clusters(_signatures(spark, d))).drop("text")


_OLD = "coalesce(source, '') = 'harbour_archive'"
_AGAINST = f", o AS (SELECT DISTINCT band, sig FROM sig JOIN docs USING (doc_id) WHERE {_OLD}), n AS (SELECT sig.* FROM sig JOIN docs USING (doc_id) WHERE NOT {_OLD}), k AS (SELECT DISTINCT doc_id FROM n JOIN o USING (band, sig))"


def _against(spark, d, only_index: bool) -> DataFrame:
    docs = _docs(spark, d).select("doc_id", "source")
    old = F.coalesce("source", F.lit("")) == "harbour_archive"
    sigs = _signatures(spark, d)
    index = dedup.band_index(sigs.join(docs.where(old), "doc_id", "left_semi"))
    fresh = docs.where(~old).drop("source")
    return dedup.minhash_dedup_against(fresh, sigs.join(fresh, "doc_id", "left_semi"), index, only_index)


@query(f"WITH {_SIG}{_AGAINST} SELECT doc_id FROM docs WHERE NOT {_OLD} AND doc_id NOT IN (SELECT doc_id FROM k)")
def dedup_minhash_only_index(spark, d):
    return _against(spark, d, True)


@query(f"""WITH RECURSIVE {_SIG}{_AGAINST}{_LINKS.replace('FROM sig', 'FROM n')}{_CLUSTERS}, h AS (SELECT DISTINCT minhash_cluster_id FROM c JOIN k USING (doc_id))
SELECT doc_id, coalesce(minhash_cluster_id, -1)::BIGINT AS minhash_cluster_id, coalesce(minhash_cluster_size, 1)::BIGINT AS minhash_cluster_size FROM docs LEFT JOIN c USING (doc_id)
WHERE NOT {_OLD} AND doc_id NOT IN (SELECT doc_id FROM k) AND (minhash_cluster_id IS NULL OR minhash_cluster_id = doc_id AND minhash_cluster_id NOT IN (SELECT minhash_cluster_id FROM h))""")
def dedup_minhash_index(spark, d):
    return _against(spark, d, False)


@query(_SHINGLES + f", o AS (SELECT DISTINCT h FROM h JOIN docs USING (doc_id) WHERE {_OLD}) SELECT DISTINCT doc_id, sent FROM h JOIN docs USING (doc_id) WHERE NOT {_OLD} AND h IN (SELECT h FROM o)")
def sentence_duplicates_index(spark, d):
    docs = _docs(spark, d).select("doc_id", "text", (F.coalesce("source", F.lit("")) == "harbour_archive").alias("old"))
    index = dedup.sentence_index(dedup.sentence_shingles(docs.where("old"), marks=False))
    return dedup.sentence_duplicates(dedup.sentence_shingles(docs.where("not old"), marks=False), index=index, only_index=True)


@query("""WITH RECURSIVE e AS (SELECT a.doc_id AS x, b.m AS y FROM documents a JOIN (SELECT text, min(doc_id) AS m FROM documents WHERE length(text) > 0 GROUP BY text) b ON a.text = b.text WHERE a.doc_id <> b.m)
SELECT x AS node, y AS component FROM e UNION SELECT y, y FROM e""")
def components_of_copies(spark, d):
    g = dedup.exact_groups(_docs(spark, d), _t()).where(F.col("doc_id") != F.col("survivor"))
    return connected_components(g.select(F.col("survivor").alias("src"), F.col("doc_id").alias("dst")))


_FIRST = f"""WITH {S.DOCS}, w AS (SELECT doc_id, {S.words(S.simplify('text'))} AS w FROM docs),
g AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i+12], ' '))) AS g FROM w WHERE len(w) >= 13),
f AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g),
c AS (SELECT g.doc_id, count(*) AS shingles, count(*) FILTER (WHERE first < g.doc_id) AS seen FROM g JOIN f USING (g) GROUP BY 1)
"""


@query(_FIRST + "SELECT d.doc_id, coalesce(shingles, 0) AS shingles, coalesce(seen, 0) AS seen, CASE WHEN seen > 0.8 * shingles THEN 'bloom_duplicate' END AS filter_reason FROM docs d LEFT JOIN c USING (doc_id)")
def dedup_bloom(spark, d):
    return dedup.first_seen_dedup(_docs(spark, d), marks=False)


@query(f"""WITH {S.DOCS}, w AS (SELECT doc_id, {S.words('text')} AS w FROM docs),
g AS (SELECT doc_id, unnest(range(0, len(w) - 49)) AS pos, unnest(list_transform(range(1, len(w) - 48), lambda i: array_to_string(w[i:i+49], chr(1)))) AS g FROM w WHERE len(w) >= 50),
h AS (SELECT doc_id, pos FROM g WHERE g IN (SELECT gg.g FROM g AS gg GROUP BY gg.g HAVING count(*) > 1)),
s AS (SELECT doc_id, pos, CASE WHEN pos <= lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 50 THEN 0 ELSE 1 END AS new FROM h),
r AS (SELECT doc_id, pos, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM s)
SELECT doc_id, min(pos)::INT AS start, (max(pos) + 50)::INT AS "end" FROM r GROUP BY doc_id, k""")
def dedup_substring(spark, d):
    return dedup.repeated_token_ranges(token_files.word_tokens(_docs(spark, d)), 50)


_GRAMS = """{0} AS (SELECT {1}, unnest(range(0, len(w) - 11)) AS pos, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i+11], ' '))) AS g FROM {2} WHERE len(w) >= 12)"""


@query(
    f"""WITH {S.DOCS}, dw AS (SELECT doc_id, {S.words(S.simplify('text'))} AS w FROM docs), bw AS (SELECT item_id, coalesce(task, '') AS task, {S.words(S.simplify('text'))} AS w FROM benchmark WHERE text IS NOT NULL),
{_GRAMS.format('dg', 'doc_id', 'dw')}, {_GRAMS.format('bg', 'task', 'bw')}, i AS (SELECT g, min(task) AS task FROM bg GROUP BY g)
SELECT doc_id, arg_min(g, pos) AS contaminated_ngram, arg_min(task, pos) AS contaminated_task, 'contaminated' AS filter_reason FROM dg JOIN i USING (g) GROUP BY doc_id"""
)
def decontaminate_ngrams(spark, d):
    index = decontaminate.ngram_index(_table(spark, d, "benchmark").where("text is not null"), marks=False)
    return decontaminate.contaminated(_docs(spark, d), index, marks=False)


# -- statistics ------------------------------------------------------------------------------------


def _stats_sql(metrics: dict[str, str], prep: str) -> str:
    return f"WITH {S.DOCS}, p AS (SELECT doc_id, text, {prep} FROM docs) SELECT doc_id, " + ", ".join(f"({v})::DOUBLE AS {k}" for k, v in metrics.items()) + " FROM p"


_DOC_SQL = {
    "length": "n",
    "white_space_ratio": S.share(S.count("text", S.WS), "n"),
    "non_alpha_digit_ratio": S.share(S.count("text", r"[^\p{L}\p{Nd}]"), "n"),
    "digit_ratio": S.share(S.count("text", r"\p{Nd}"), "n"),
    "uppercase_ratio": S.share(S.count("text", r"\p{Lu}"), "n"),
    "elipsis_ratio": S.share(f"3 * {S.count('text', r'[.][.][.]')} + {S.count('text', '…')}", "n"),
    "punctuation_ratio": S.share(S.count("text", X.punctuation_class()), "n"),
}


@query(_stats_sql(_DOC_SQL, "length(text) AS n"))
def stats_doc(spark, d):
    return stats.with_metrics(_docs(spark, d), stats.doc_metrics(_t()), "doc_id")


_LINE_SQL = {
    "n_lines": "len(l)", "avg_line_length": S.share(S.total("l"), "len(l)"),
    "short_line_ratio_chars_10": S.ratio_of("l", "length(x) <= 10"), "short_line_ratio_chars_30": S.ratio_of("l", "length(x) <= 30"),
    "long_line_ratio_chars_2000": S.ratio_of("l", "length(x) >= 2000"), "long_line_ratio_chars_10000": S.ratio_of("l", "length(x) >= 10000"),
    "lines_ending_with_terminal_mark_ratio": S.ratio_of("l", "regexp_matches(x, '[.?!\"'']\\z')"),
    "bullet_point_lines_ratio": S.ratio_of("l", f"regexp_matches(x, {S.q(_BULLETS)})"),
    "line_duplicates": S.share(S.dup_n("l"), "len(l)"), "line_char_duplicates": S.share(S.dup_c("l"), "length(text)"),
}


@query(_stats_sql(_LINE_SQL, "string_split(text, chr(10)) AS l"))
def stats_line(spark, d):
    return stats.unit_metrics(_docs(spark, d), "line", stats.line_metrics, "doc_id")


_PARA_SQL = {
    "n_paragraphs": "len(l)", "avg_paragraph_length": S.share(S.total("l"), "len(l)"), "short_paragraph_ratio_100": S.ratio_of("l", "length(x) <= 100"),
    "long_paragraph_ratio_1000": S.ratio_of("l", "length(x) >= 1000"), "paragraph_duplicates": S.share(S.dup_n("l"), "len(l)"), "paragraph_char_duplicates": S.share(S.dup_c("l"), S.total("l")),
}


@query(_stats_sql(_PARA_SQL, f"list_filter(string_split(text, chr(10) || chr(10)), lambda x: {S.strip('x')} <> '') AS l"))
def stats_paragraph(spark, d):
    return stats.unit_metrics(_docs(spark, d), "paragraph", stats.paragraph_metrics, "doc_id")


_SENT_SQL = {"n_sentences": "len(l)", "avg_sentence_length": S.share(S.total("l"), "len(l)"), "short_sentence_ratio_20": S.ratio_of("l", "length(x) <= 20"), "long_sentence_ratio_75": S.ratio_of("l", "length(x) >= 75")}


@query(_stats_sql(_SENT_SQL, f"{S.sentences('text')} AS l"))
def stats_sentence(spark, d):
    return stats.unit_metrics(_docs(spark, d), "sentence", stats.sentence_metrics, "doc_id")


_WORD_SQL = {
    "n_words": "len(w)", "avg_word_length": S.share(S.total("w"), "len(w)"), "avg_words_per_line": S.share("len(w)", f"len({S.split_lines('text')})"),
    "short_word_ratio_3": S.ratio_of("w", "length(x) <= 3"), "long_word_ratio_7": S.ratio_of("w", "length(x) >= 7"), "type_token_ratio": S.share("len(list_distinct(w))", "len(w)"),
    "uppercase_word_ratio": S.ratio_of("w", r"regexp_matches(x, '\p{Lu}') AND NOT regexp_matches(x, '[\p{Ll}\p{Lt}]')"),
    "capitalized_word_ratio": S.ratio_of("w", r"regexp_matches(x, '^[\p{Lu}\p{Lt}][^\p{Lu}\p{Lt}]*\z')"),
    "stop_word_ratio": S.ratio_of("w", f"list_contains({_STOPS}, x)"),
}


@query(_stats_sql(_WORD_SQL, f"{S.words('text')} AS w"))
def stats_word(spark, d):
    return stats.unit_metrics(_docs(spark, d), "word", lambda t, w: stats.word_metrics(t, w, filters.STOP_WORDS), "doc_id")


@query(_stats_sql({"words_contamination_harvest": S.ratio_of("w", "x IN ('harvest', 'money')")}, f"string_split({S.simplify('text')}, ' ') AS w"))
def stats_contamination(spark, d):
    return stats.unit_metrics(_docs(spark, d), "simple_word", lambda t, w: stats.contamination_metrics(t, w, ["harvest", "money"]), "doc_id")


_FLAT = "WITH m AS (" + _stats_sql(_DOC_SQL, "length(text) AS n") + "), f AS (SELECT m.doc_id, source, stat, value FROM (UNPIVOT m ON COLUMNS(* EXCLUDE doc_id) INTO NAME stat VALUE value) m JOIN documents USING (doc_id)) "
_AGG = """round(d, 4)::DOUBLE AS total, n, round(d::DOUBLE / n, 6) AS mean, min, max, round(CASE WHEN n > 1 THEN greatest(0.0, (q - d::DOUBLE * d::DOUBLE / n) / (n - 1)) ELSE 0.0 END, 4) AS variance
FROM (SELECT {0} sum(value::DECIMAL(18, 6)) AS d, sum(value::DECIMAL(38, 6) * value::DECIMAL(38, 6))::DOUBLE AS q, count(value) AS n, min(value) AS min, max(value) AS max FROM f GROUP BY ALL)"""


def _flat(spark, d) -> DataFrame:
    metrics = stats.doc_metrics(_t())
    wide = stats.with_metrics(_docs(spark, d), metrics, "doc_id", "source")
    return stats.unpivoted(wide, list(metrics), "doc_id", "source")


@query(_FLAT + "SELECT stat, " + _AGG.format("stat,"))
def stats_summary(spark, d):
    return stats.summary(_flat(spark, d))


@query(_FLAT + "SELECT source, stat, " + _AGG.format("source, stat,"))
def stats_by_source(spark, d):
    return stats.summary(_flat(spark, d), "source")


_HOSTED = "WITH m AS (" + _stats_sql(_DOC_SQL, "length(text) AS n") + f"), u AS (SELECT doc_id, regexp_extract({_URL}, '^https://([^/]+)', 1) AS host FROM documents), f AS (SELECT host, regexp_extract(host, '([^.]+)$', 1) AS suffix, stat, value FROM (SELECT doc_id, stat, value FROM (UNPIVOT m ON COLUMNS(* EXCLUDE doc_id) INTO NAME stat VALUE value)) JOIN u USING (doc_id)) "


def _hosted(spark, d) -> DataFrame:
    metrics = stats.doc_metrics(_t())
    url = F.concat(F.lit("https://www."), F.coalesce(F.replace(F.lower("source"), F.lit(" "), F.lit("-")), F.lit("none")), F.lit(".example.com/"), F.col(_META))
    named = _docs(spark, d).withColumn("host", stats.host(url)).withColumn("suffix", stats.suffix(F.col("host")))
    return stats.unpivoted(stats.with_metrics(named, metrics, "host", "suffix"), list(metrics), "host", "suffix")


@query(_HOSTED + "SELECT host, stat, " + _AGG.format("host, stat,"))
def stats_by_host(spark, d):
    return stats.summary(_hosted(spark, d), "host")


@query(_HOSTED + "SELECT suffix, stat, " + _AGG.format("suffix, stat,"))
def stats_by_suffix(spark, d):
    return stats.summary(_hosted(spark, d), "suffix")


@query("WITH m AS (" + _stats_sql(_DOC_SQL, "length(text) AS n") + "), f AS (SELECT doc_id, length AS chars, stat, value FROM (SELECT doc_id, length, unnest(['white_space_ratio', 'digit_ratio', 'uppercase_ratio']) AS stat, unnest([white_space_ratio, digit_ratio, uppercase_ratio]) AS value FROM m)) SELECT stat, round(value, 3) AS key, count(*) AS n, sum(chars)::BIGINT AS chars FROM f GROUP BY 1, 2")
def stats_histogram(spark, d):
    m = {k: v for k, v in stats.doc_metrics(_t()).items() if k in ("white_space_ratio", "digit_ratio", "uppercase_ratio")}
    wide = stats.with_metrics(_docs(spark, d), m | {"chars": F.length("text").cast("long")}, "doc_id")
    return stats.histogram(stats.unpivoted(wide, list(m), "doc_id", "chars"), "chars")


@query(f"WITH {S.DOCS}, w AS (SELECT unnest(list_transform({S.words('text')}, lambda x: lower(x))) AS word FROM docs) SELECT word, count(*) AS n FROM w GROUP BY word ORDER BY n DESC, word LIMIT 100")
def stats_topk(spark, d):
    words = _docs(spark, d).select(F.explode(F.transform(X.words(_t()), lambda w: F.lower(w))).alias("word"))
    return stats.top_keys(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "word", k=100)


@query("SELECT lang, source, count(*) AS n, sum(n_chars)::BIGINT AS total FROM documents GROUP BY ROLLUP (lang, source)")
def stats_rollup(spark, d):
    return stats.by_level(_table(spark, d, "documents"), "lang", "source", "n_chars")


# -- formatters and repair ----------------------------------------------------------------------------


@query(f"""SELECT doc_id, regexp_replace(text || ' mail ' || doc_id::VARCHAR || '.x@post.example.com', {S.q(formatters.EMAIL)}, 'email@example.com', 'g') AS text FROM documents""")
def format_pii(spark, d):
    shown = F.concat(_t(), F.lit(" mail "), F.col("doc_id").cast("string"), F.lit(".x@post.example.com"))
    return _table(spark, d, "documents").select("doc_id", formatters.mask_emails(shown).alias("text"))


@query()
def format_pii_turns(spark, d):
    return _docs(spark, d).select("doc_id", formatters.mask_pii(_t()).alias("text"))


_SYMBOLS = f"^[ {X.punctuation_class()[1:-1]}{X.terminal_class()}]+\\z"


@query(f"WITH {S.DOCS} SELECT doc_id, coalesce(array_to_string(list_filter({S.split_lines('text')}, lambda x: NOT ({S.strip('x')} <> '' AND regexp_matches(x, {S.q(_SYMBOLS)}))), chr(10)), '') AS text FROM docs")
def format_symbol_lines(spark, d):
    return _docs(spark, d).select("doc_id", formatters.drop_symbol_lines(_t()).alias("text"))


@query()
def format_encoding(spark, d):
    return _docs(spark, d).select("doc_id", formatters.fix_encoding(_t()).alias("text"))


@query()
def extract_html(spark, d):
    body = F.replace(F.replace(F.replace(_t(), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("\n"), F.lit("</p><p>"))
    page = F.concat(F.lit("<html><head><script>var x;</script></head><body><nav>Home</nav><article><p>"), body, F.lit("</p></article><footer>Imprint</footer></body></html>"))
    return _docs(spark, d).select("doc_id", formatters.extract_html(page).alias("x")).select("doc_id", "x.text", "x.status")


_LIGATURED = "text"
for _a, _b in repair.LIGATURES.items():
    _LIGATURED = f"replace({_LIGATURED}, {S.q(_a)}, {S.q(_b)})"


@query(
    f"""WITH {S.DOCS}, a AS (SELECT doc_id, text AS t0, regexp_replace(replace(replace(nfc_normalize(regexp_replace(text, '\\r\\n?', chr(10), 'g')), chr(160), ' '), chr(8203), ''), '[\\x00-\\x08\\x0B\\x0D-\\x1F\\x7F-\\x{{9F}}]', '', 'g') AS text FROM docs),
b AS (SELECT doc_id, t0, {S.count('text', '[ﬀ-ﬆ]')} AS lig, {_LIGATURED} AS text FROM a),
c AS (SELECT *, length(text) - length(replace(text, chr(173), '')) AS soft, regexp_replace(text, '(\\p{{L}})\\x{{AD}}[ \\t]*\\n[ \\t]*(\\p{{L}})', '\\1' || chr(57344) || '\\2', 'g') AS j FROM b),
e AS (SELECT *, length(j) - length(replace(j, chr(57344), '')) AS joins, replace(replace(j, chr(57344), ''), chr(173), '') AS t3 FROM c),
f AS (SELECT *, regexp_replace(t3, '[ \\t]+(\\n|\\z)', '\\1', 'g') AS t5 FROM e),
g AS (SELECT *, regexp_replace(t5, '\\n{{4,}}', chr(10) || chr(10) || chr(10), 'g') AS t6 FROM f)
SELECT doc_id, t6 AS text, lig::BIGINT AS ligatures_normalized, soft::BIGINT AS soft_hyphens_removed, joins::BIGINT AS soft_hyphen_line_joins, (length(t3) - length(t5))::BIGINT AS trailing_whitespace_removed, (length(t5) - length(t6))::BIGINT AS blank_lines_collapsed FROM g"""
)
def repair_unicode(spark, d):
    out = repair.packed(repair.normalize_unicode(repair.start(_docs(spark, d).select("doc_id", "text"))))
    fields = ("ligatures_normalized", "soft_hyphens_removed", "soft_hyphen_line_joins", "trailing_whitespace_removed", "blank_lines_collapsed")
    return out.select("doc_id", "text", *[F.col(f"repair.{f}").alias(f) for f in fields])


_MARKUP = "text || chr(10) || '![plate](img/' || doc_id::VARCHAR || '.png)' || chr(10) || 'Note: the image is not available here' || chr(10) || 'a <IMG src=\"x\"> b'"


@query(
    f"""WITH {S.DOCS}, m AS (SELECT doc_id, {_MARKUP} AS t FROM docs), l AS (SELECT doc_id, string_split(t, chr(10)) AS l FROM m),
n AS (SELECT doc_id, l, list_filter(l, lambda x: NOT (starts_with(lower({S.strip('x')}), 'note:') AND ((contains(lower(x), 'image') AND contains(lower(x), 'not available')) OR (contains(lower(x), 'image placeholder') AND contains(lower(x), 'text-based'))))) AS r FROM l),
k AS (SELECT doc_id, l, r, list_sum(list_transform(r, lambda x: {S.count('x', r'!\[[^\]\n]*\]\([^\n)]*\)')} + {S.count('x', r'(?i)<img\b[^>]*>')})) AS images,
 list_transform(list_filter(r, lambda x: {S.strip(r"regexp_replace(regexp_replace(x, '!\[[^\]\n]*\]\([^\n)]*\)', '', 'g'), '(?i)<img\b[^>]*>', '', 'g')")} <> '' OR {S.strip('x')} = ''), lambda x: regexp_replace(regexp_replace(x, '!\\[[^\\]\\n]*\\]\\([^\\n)]*\\)', '', 'g'), '(?i)<img\\b[^>]*>', '', 'g')) AS kept FROM n)
SELECT doc_id, array_to_string(kept, chr(10)) AS text, images::BIGINT AS image_placeholders_removed, (len(l) - len(r))::BIGINT AS image_notes_removed FROM k"""
)
def repair_image(spark, d):
    marked = F.concat(_t(), F.lit("\n![plate](img/"), F.col("doc_id").cast("string"), F.lit('.png)\nNote: the image is not available here\na <IMG src="x"> b'))
    out = repair.packed(repair.remove_images(repair.start(_docs(spark, d).select("doc_id", marked.alias("text")))))
    return out.select("doc_id", "text", "repair.image_placeholders_removed", "repair.image_notes_removed")


def _record(df: DataFrame, *fields: str) -> DataFrame:
    return df.select("doc_id", F.length("text").alias("chars"), *[F.col(f"repair.{f}").alias(f) for f in fields])


@query()
def repair_page_structure(spark, d):
    out = repair.packed(repair.repair_page_structure(repair.start(_docs(spark, d).select("doc_id", "text"))))
    return _record(out, "pages_detected", "headers_removed", "footers_removed", "page_numbers_removed", "boundary_joins")


@query()
def repair_local_span(spark, d):
    return _record(repair.packed(repair.repair_local_spans(repair.start(_docs(spark, d).select("doc_id", "text")))), "duplicate_blocks_removed")


@query()
def repair_line_loop(spark, d):
    return _record(repair.packed(repair.repair_line_loops(repair.start(_docs(spark, d).select("doc_id", "text")))), "long_line_loops_removed", "loop_chars_removed")


@query()
def repair_book(spark, d):
    out = repair.repair_book(_docs(spark, d).select("doc_id", "text"))
    return _record(out, "chars_before", "chars_after", "removed_fraction", "repair_confidence")


@query(
    f"""WITH {S.DOCS}, f AS (SELECT doc_id, round(greatest(0, length(text) - length({S.strip('text')}))::DOUBLE / length(text), 6) AS removed_fraction FROM docs)
SELECT doc_id, removed_fraction, round(greatest(0.0, least(1.0, 1.0 - greatest(0.0, removed_fraction - 0.2) * 0.7)), 5) AS repair_confidence FROM f"""
)
def repair_metrics(spark, d):
    begun = repair.start(_docs(spark, d).select("doc_id", "text")).withColumn("text", X.strip(_t()))
    out = repair.metrics(begun)
    return out.select("doc_id", F.col("repair.removed_fraction").alias("removed_fraction"), F.round("repair.repair_confidence", 5).alias("repair_confidence"))


# -- tokens -------------------------------------------------------------------------------------------


@query()
def token_count(spark, d):
    from ..functions.tokens import with_tokens

    return with_tokens(_docs(spark, d).select("doc_id", "text")).select("doc_id", "token_count")


@query()
def token_count_histogram(spark, d):
    from ..functions.tokens import with_tokens

    return with_tokens(_docs(spark, d).select("doc_id", "text")).groupBy("token_count").agg(F.count(F.lit(1)).alias("n"))


@query()
def tokenize_documents(spark, d):
    out = token_files.shuffled(token_files.token_stream(_docs(spark, d)))
    return out.select("doc_id", "n_tokens", "shuffle_key", F.xxhash64("tokens").alias("tokens_hash"))


@query(f"WITH {S.DOCS}, n AS (SELECT doc_id, len({S.words('text')})::BIGINT AS n_tokens FROM docs), o AS (SELECT doc_id, n_tokens, (sum(n_tokens) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - n_tokens)::BIGINT AS token_start FROM n) SELECT *, token_start // 100000 AS file_id FROM o")
def token_merge(spark, d):
    sized = token_files.word_tokens(_docs(spark, d)).select("doc_id", F.size("tokens").cast("long").alias("n_tokens"))
    out = token_files.file_of(token_files.with_offsets(sized, ranges=64), 100_000)
    return out.select("doc_id", "n_tokens", "token_start", "file_id")


@query(f"""WITH {S.DOCS}, n AS (SELECT doc_id, len({S.words('text')})::BIGINT AS n FROM docs), o AS (SELECT doc_id, n, sum(n) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - n AS s, sum(n) OVER () AS total FROM n),
w AS (SELECT doc_id, n, s, total, unnest(range((s // 2049)::BIGINT, ((s + n - 1) // 2049)::BIGINT + 1)) AS window_id FROM o WHERE n > 0)
SELECT window_id, doc_id, (greatest(s, window_id * 2049) - s)::BIGINT AS first_pos, (least(s + n, (window_id + 1) * 2049) - s - 1)::BIGINT AS last_pos FROM w WHERE (window_id + 1) * 2049 <= total""")
def context_windows(spark, d):
    return token_files.context_windows(token_files.word_tokens(_docs(spark, d)), 2049)


@query(f"WITH {S.DOCS}, w AS (SELECT doc_id, {S.words('text')} AS w FROM docs) SELECT doc_id, (unnest(range(0, len(w))))::INT AS position, unnest(w) AS token FROM w")
def token_positions(spark, d):
    return token_files.positions(token_files.word_tokens(_docs(spark, d)))


# -- other ---------------------------------------------------------------------------------------------


@query()
def inference_rollouts(spark, d):
    return inference.rollouts(_docs(spark, d), count=2)


@query("SELECT time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start, event_type, count(*) AS n, round(count(*) / 300.0, 6) AS per_second FROM events GROUP BY 1, 2")
def events_rate_window(spark, d):
    return rate_windows(_table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(
    f"""WITH {S.DOCS}, f AS (SELECT doc_id, lang, text, {_LONG} AS shown FROM docs), g AS (SELECT doc_id, lang, text, CASE WHEN {S.strip('text')} = '' THEN 'empty_text' WHEN {S.dup_c('shown')} > 0.8 * length(text) THEN 'extreme_repeated_lines' END AS reason FROM f),
r AS (SELECT *, CASE WHEN reason IS NULL AND row_number() OVER (PARTITION BY text, reason IS NULL ORDER BY doc_id) > 1 THEN 'exact_dedup' ELSE reason END AS why FROM g)
SELECT lang, coalesce(why, 'kept') AS outcome, count(*) AS n FROM r GROUP BY 1, 2"""
)
def flagship(spark, d):
    """Read, gate, deduplicate; per language what is kept and what is dropped for which reason."""
    # texts are read and judged once; the rest works on their hashes
    judged = spread(_docs(spark, d).select("doc_id", "lang", "text")).select("doc_id", "lang", X.sha1_64(_t()).alias("hash"), filters.book_quality(_t()).alias("filter_reason"))
    kept, dropped = filters.tee(materialize(judged, "judged"), F.col("filter_reason"))
    groups = dedup.exact_groups(kept, F.col("hash").cast("string")).select("lang", F.when(F.col("doc_id") == F.col("survivor"), "kept").otherwise("exact_dedup").alias("outcome"))
    return groups.unionByName(dropped.select("lang", F.col("filter_reason").alias("outcome"))).groupBy("lang", "outcome").agg(F.count(F.lit(1)).alias("n"))
