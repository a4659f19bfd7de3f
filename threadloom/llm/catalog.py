"""The registered queries of this folder, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import (
    decontamination,
    embedding_graph,
    hard_negatives,
    html_text,
    language,
    line_dedup,
    pieces,
    pii,
    simhash,
    source_audit,
    substring,
    toxicity,
    url_filter,
)
from threadloom.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]

# Verdicts by host and path.
URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
LANGUAGE_FOLDS, LANGUAGE_HELD_OUT = 5, 0
TOXICITY_FOLDS, TOXICITY_HELD_OUT = 4, 2
ANCHOR_EVERY = 50


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = html_text.extract(table(spark, sf_dir, "pages"))
    return made.select(F.col("id").alias("page_id"), "url", "text", "n_chars")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = pieces.encode(docs, verify_into="lossless")
    return both.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.size("piece_ids").cast("long").alias("n_pieces"),
        "lossless",
        "piece_ids",
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, fold("doc_id", LANGUAGE_FOLDS) != LANGUAGE_HELD_OUT)
    held_out = F.coalesce(fold("doc_id", LANGUAGE_FOLDS) == LANGUAGE_HELD_OUT, F.lit(False))
    return language.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = line_dedup.strip_shared_lines(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return made.select("doc_id", F.col("n_lines").cast("long"), F.col("n_removed").cast("long"), "text")


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_graph.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "score", "decided_by")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", TOXICITY_FOLDS) != TOXICITY_HELD_OUT)
    scored = toxicity.score(docs, index).withColumnRenamed("id", "doc_id")
    held_out = F.coalesce(fold("doc_id", TOXICITY_FOLDS) == TOXICITY_HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "evidence", "cosines")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_windows", "first_word", "changed")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"), words=3)
    return groups.select(
        F.col("id").alias("doc_id"), simhash.hex_of("fp").alias("fingerprint"), F.col("component").alias("component_id")
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op11_source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = source_audit.audit(table(spark, sf_dir, "documents"))
    pairs = made.pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", "rank")
    terms = made.terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(terms)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", "embedding", turned.alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % ANCHOR_EVERY == 0)


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"), into="pii")
    base = F.filter("pii", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("pii", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in pii.BASE),
        F.sha2(pii.joined(base), 256).alias("base_sha256"),
        pii.joined(F.col("pii")).alias("spans"),
    )


QUERIES: dict[str, Query] = {
    build.__name__: build
    for build in (
        op1_html_extraction,
        op2_sentencepiece,
        op3_language_id,
        op4_line_dedup,
        op5_embedding_near_dedup,
        op6_url_filter,
        op7_toxicity,
        op8_decontamination,
        op9_simhash_near_dedup,
        op10_substring_dedup,
        op11_source_divergence_audit,
        op12_hard_negatives,
        op13_pii,
    )
}

ORACLES: dict[str, str] = {
    "op4_line_dedup": f"""
with lines as (
    select doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) as pos,
           unnest(string_split(text, chr(10))) as line
    from documents
),
shared as (
    select trim(line) as k from lines where trim(line) <> '' group by 1
    having count(distinct source) >= {line_dedup.MIN_SITES}
),
marked as (select l.doc_id, l.pos, l.line, s.k is not null as gone from lines l left join shared s on trim(l.line) = s.k),
cut as (
    select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_gone,
           string_agg(line, chr(10) order by pos) filter (where not gone) as left_text,
           count(*) filter (where not gone and trim(line) <> '') = 0 as whole
    from marked group by doc_id
)
select d.doc_id, coalesce(n_lines, 0) as n_lines,
       case when whole then 0 else coalesce(n_gone, 0) end as n_removed,
       case when whole or d.text is null then d.text else coalesce(left_text, '') end as text
from documents d left join cut c on d.doc_id = c.doc_id
""",
    "op11_source_divergence_audit": f"""
with docs as (
    select row_number() over () as k, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text
    from documents
),
words as (
    select k, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
    from docs
),
terms as (
    select lang, term, count(*)::hugeint as total from words group by all having count(distinct k) >= {source_audit.MIN_DOCS}
),
cells as (select lang, source, term, count(*)::hugeint as n from words join terms using (lang, term) group by all),
langs as (select lang, count(*)::hugeint as v, sum(total)::hugeint as n_lang from terms group by lang),
groups as (
    select g.lang, g.source, coalesce(v, 0)::hugeint as v, coalesce(n_lang, 0)::hugeint as n_lang,
           coalesce((select sum(n) from cells c where c.lang = g.lang and c.source = g.source), 0)::hugeint as n_group
    from (select distinct lang, source from docs) g left join langs l on g.lang = l.lang
),
shares as (
    select g.lang, g.source, t.term, coalesce(c.n, 0) as n,
           1 + 1000000000::hugeint * (coalesce(c.n, 0) + 2) // (n_group + 2 * v) as p,
           1 + 1000000000::hugeint * (t.total + 2) // (n_lang + 2 * v) as q
    from groups g join terms t on g.lang = t.lang
    left join cells c on c.lang = g.lang and c.source = g.source and c.term = t.term
),
distances as (
    select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
    from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
),
pairs as (
    select a.lang, a.source, b.source as item, coalesce(d.value, 0) as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join distances d on d.lang = a.lang and d.source = a.source and d.item = b.source
),
told as (select lang, source, term as item, (p - q) * (p - q) // (p + q) as value from shares where n > 0 and p > q),
ranked as (
    select lang, source, 'pair' as part, item, value from pairs union all select lang, source, 'term', item, value from told
),
numbered as (
    select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from ranked
)
select lang, source, part, item, value::bigint as value, rank::int as rank from numbered
where part = 'pair' or rank <= {source_audit.TOP_TERMS}
""",
    "op12_hard_negatives": f"""
with rows as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor({hard_negatives.SCALE} * x::double)::bigint::double) as v
    from embeddings
    where label is not null and embedding is not null
          and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scores as (
    select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
    from rows a join rows b on a.vec_id <> b.vec_id where a.vec_id % {ANCHOR_EVERY} = 0
),
positives as (
    select anchor_id, other_id as positive_id, score as positive_score from scores where same
    qualify row_number() over (partition by anchor_id order by score desc, other_id) <= {hard_negatives.POSITIVES}
)
select anchor_id, positive_id,
       row_number() over (partition by anchor_id, positive_id order by score desc, other_id)::int as rank,
       other_id as negative_id, positive_score, score as negative_score
from positives join scores using (anchor_id)
where not same and {hard_negatives.LOW} * positive_score <= 100 * score and 100 * score <= {hard_negatives.HIGH} * positive_score
qualify rank <= {hard_negatives.NEGATIVES}
""",
}
