"""Chunk, embedding and similarity queries."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.catalog.models import TOP_COMMENTS_CTE, mart
from threadloom.catalog.registry import query, table
from threadloom.catalog.roles import STAGED_CTES, sql_clean, sql_strip
from threadloom.functions.vectors import cosine
from threadloom.operators import chunking, context, embedding, ivf, keyword, similarity
from threadloom.operators.cleaning import with_clean_text
from threadloom.plans.index import read_index, retrieve, update_index
from threadloom.session import stored, work_dir
from threadloom.sources.tables import spread

# Chunk boundaries are found piece by piece: s holds the offsets at which pieces
# start and the length of the text, i and j number the first and last of a chunk.
CUT_CTES = f"""words as (
  select post_id, unnest(string_split(text, ' ')) as word,
    generate_subscripts(string_split(text, ' '), 1) as n from texts),
starts as (
  select post_id, n, greatest(0, coalesce(sum(length(word) + 1) over (
    partition by post_id order by n rows between unbounded preceding and 1 preceding), 0) - 1)
    as s from words),
bounds as (
  select post_id, subreddit, text, list_append(s, length(text)) as s
  from texts join (select post_id, list(cast(s as bigint) order by n) as s
    from starts group by post_id) using (post_id)),
cuts as (
  select post_id, 1 as n, cast(1 as bigint) as i,
    len(list_filter(s, lambda x: x - s[1] <= 500)) as j from bounds
  union all
  select post_id, n + 1, i, len(list_filter(s, lambda x: x - s[i] <= 500)) from (
    select c.post_id, c.n, b.s, len(list_filter(b.s,
      lambda x: x < greatest(b.s[c.j] - 50, b.s[c.j + 1] - 500))) + 1 as i
    from cuts c join bounds b using (post_id) where c.j < len(b.s))),
cut_texts as (
  select post_id as doc_id, n, subreddit,
    {sql_strip("substring(text, s[i] + 1, s[j] - s[i])")} as chunk_text
  from cuts join bounds using (post_id)),
post_chunks as (
  select doc_id, row_number() over (partition by doc_id order by n) - 1 as chunk_no,
    chunk_text, subreddit from cut_texts where chunk_text <> '')
"""
CHUNK_CTES = f"""{STAGED_CTES},
texts as (select distinct post_id, subreddit, post_title || ' ' || post_body as text
  from fct_posts),
{CUT_CTES}"""


@query(f"with recursive {CHUNK_CTES} select * from post_chunks")
def chunk_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = chunking.chunk_posts(mart(spark, sf_dir))
    return chunks.select(
        "doc_id", "chunk_no", "chunk_text", F.col("metadata")["SUBREDDIT"].alias("subreddit")
    )


@query(
    f"""with {STAGED_CTES} select comment_id as doc_id, 0 as chunk_no,
      comment_body as chunk_text, post_id
    from fct_posts where comment_body is not null and comment_body <> ''"""
)
def chunk_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = chunking.chunk_comments(mart(spark, sf_dir))
    return chunks.select(
        "doc_id", "chunk_no", "chunk_text", F.col("metadata")["POST_ID"].alias("post_id")
    )


CONTEXT_CTES = f"""{STAGED_CTES}, {TOP_COMMENTS_CTE},
forums as (select distinct post_id, subreddit from fct_posts),
parts as (
  select distinct post_id, 0 as rank, post_title || ' ' || post_body as text from fct_posts
  union all select post_id, rank, comment_body from top_comments),
texts as (
  select post_id, any_value(subreddit) as subreddit, string_agg(text, ' ' order by rank) as text
  from parts join forums using (post_id) group by post_id),
{CUT_CTES}"""


@query(f"with recursive {CONTEXT_CTES} select doc_id, chunk_no, chunk_text from post_chunks")
def chunk_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, body and best comments of every post as one document, in chunks."""
    return chunking.chunk_contexts(context.post_context(mart(spark, sf_dir), 2, separator=" "))


# The keys of the metadata maps.
METADATA_KEYS = [
    "POST_AUTHOR",
    "LINK_FLAIR_TEXT",
    "POST_ID",
    "SUBREDDIT",
    "POST_URL",
    "COMMENT_ID",
    "COMMENT_AUTHOR",
    "COMMENT_PARENT_ID",
    "COMMENT_PERMALINK",
    "type",
]


@query(
    f"""with {STAGED_CTES}
    select distinct post_author as POST_AUTHOR, link_flair_text as LINK_FLAIR_TEXT,
      post_id as POST_ID, subreddit as SUBREDDIT, post_url as POST_URL,
      cast(null as varchar) as COMMENT_ID, cast(null as varchar) as COMMENT_AUTHOR,
      cast(null as varchar) as COMMENT_PARENT_ID,
      cast(null as varchar) as COMMENT_PERMALINK, 'post' as type
    from fct_posts
    union all
    select null, null, post_id, subreddit, null, comment_id, comment_author,
      comment_parent_id, comment_permalink, 'comment'
    from fct_posts where comment_body is not null and comment_body <> ''"""
)
def metadata_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maps of all documents, their keys as columns."""
    chunks = chunking.corpus(mart(spark, sf_dir)).where("chunk_no = 0")
    return chunks.select(*[F.try_element_at("metadata", F.lit(k)).alias(k) for k in METADATA_KEYS])


@query(
    f"""with recursive {CHUNK_CTES}
    select 'post' as type, doc_id, chunk_no, length(chunk_text) as n_chars from post_chunks
    union all select 'comment', comment_id, 0, length(comment_body)
    from fct_posts where comment_body is not null and comment_body <> ''"""
)
def union_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = chunking.corpus(stored(mart(spark, sf_dir), "mart"))
    return chunks.select(
        F.col("metadata")["type"].alias("type"),
        "doc_id",
        "chunk_no",
        F.length("chunk_text").alias("n_chars"),
    )


def weights_sql(source: str, keys: str, text: str) -> str:
    """Non-zero components of the default embedding, as stored in single precision."""
    return f"""(with w as (
      select {keys}, unnest(list_filter(string_split_regex(lower({text}), ' +'),
        lambda x: x <> '')) as word from {source}),
    c as (select {keys}, cast('0x' || substring(md5(word), 1, 8) as bigint) % 256 as dim,
      count(*) as n from w group by all)
    select {keys}, dim, cast(cast(n / sqrt(sum(n * n) over (partition by {keys})) as float)
      as double) as weight from c)"""


@query(
    f"""with recursive {CHUNK_CTES}
    select doc_id, chunk_no, dim, round(weight, 6) as weight
    from {weights_sql("post_chunks", "doc_id, chunk_no", "chunk_text")}"""
)
def embed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components other than zero of the embeddings of all post chunks."""
    vectors = embedding.embed_chunks(chunking.chunk_posts(mart(spark, sf_dir)))
    return (
        vectors.select("doc_id", "chunk_no", F.posexplode("embedding").alias("dim", "weight"))
        .where("weight <> 0")
        .withColumn("weight", F.round(F.col("weight").cast("double"), 6))
    )


@query(
    f"""with {STAGED_CTES} select comment_id as doc_id,
      case when depth = 0 and comment_score > 300 then 'first' else 'second' end as run
    from fct_posts f join stg_comments c on c.id = f.comment_id"""
)
def embed_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of the long comments, then of all: the second run adds the others only."""
    path = work_dir(spark, "index")
    comments = stored(mart(spark, sf_dir), "mart")
    some = comments.where("comment_score > 300")
    update_index(spark, chunking.with_chunk_id(chunking.chunk_comments(some)), path, "first")
    chunks = chunking.with_chunk_id(chunking.chunk_comments(comments))
    update_index(spark, chunks, path, "second")
    return read_index(spark, path).select("doc_id", "run")


INDEXED_SQL = """select comment_id as doc_id, comment_body as chunk_text, subreddit,
  cast(post_created_at as date) as date from fct_posts
  where comment_body is not null and comment_body <> ''"""


@query(f"""with {STAGED_CTES} {INDEXED_SQL}""")
def index_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of older texts, more of them and in other places, brought up to date twice."""
    path = work_dir(spark, "index")
    comments = stored(chunking.chunk_comments(mart(spark, sf_dir)), "chunks")
    third = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    old = comments.withColumn("chunk_no", F.explode(F.when(third, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    old = old.withColumn("chunk_text", F.when(third, F.lit("an older text")).otherwise(F.col("chunk_text")))
    old = old.withColumn("subreddit", F.when(third, F.lit("elsewhere")).otherwise(F.col("subreddit")))
    update_index(spark, chunking.with_chunk_id(old), path, "first")
    for run in ("second", "third"):
        update_index(spark, chunking.with_chunk_id(comments), path, run)
    return read_index(spark, path).select("doc_id", "chunk_text", "subreddit", "date")


WINDOW_START = datetime(2023, 11, 14, 22, 45)


@query(
    f"""with {STAGED_CTES}, rows as (
      {INDEXED_SQL.replace("cast(post_created_at as date) as date", "post_created_at")})
    select doc_id, chunk_text, subreddit from rows
    where post_created_at >= timestamp '2023-11-14 22:45:00'"""
)
def index_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All comments indexed, then half of them again with a window: what is older leaves."""
    path = work_dir(spark, "index")
    chunks = stored(chunking.with_chunk_id(chunking.chunk_comments(mart(spark, sf_dir))), "chunks")
    update_index(spark, chunks, path, "first")
    some = chunks.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    update_index(spark, some, path, "second", oldest=WINDOW_START)
    return read_index(spark, path).select("doc_id", "chunk_text", "subreddit")


@query(
    f"""with recursive {CHUNK_CTES},
    forum_chunks as (select * from post_chunks where subreddit in ('src1', 'src2')),
    items as (select item_id, {sql_clean("text")} as text from benchmark),
    d as (select * from {weights_sql("forum_chunks", "doc_id, chunk_no", "chunk_text")}),
    q as (select * from {weights_sql("items", "item_id", "text")}),
    scores as (
      select item_id as question_id, doc_id, chunk_no, round(sum(d.weight * q.weight)
        / any_value(qn.norm) / any_value(dn.norm), 6) as score
      from d join q using (dim)
        join (select doc_id, chunk_no, sqrt(sum(weight * weight)) as norm from d
          group by doc_id, chunk_no) dn using (doc_id, chunk_no)
        join (select item_id, sqrt(sum(weight * weight)) as norm from q group by item_id) qn
          using (item_id)
      group by item_id, doc_id, chunk_no)
    select question_id, max(score) as best, count(*) filter (where score >= 0.4) as n_hits
    from scores group by question_id having max(score) >= 0.4"""
)
def retrieve_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hits of every benchmark item among the chunks of two forums of an index."""
    path = work_dir(spark, "index")
    update_index(spark, chunking.with_chunk_id(chunking.chunk_posts(mart(spark, sf_dir))), path, "first")
    items = with_clean_text(table(spark, sf_dir, "benchmark"), "text", "question")
    index = read_index(spark, path).where(F.col("subreddit").isin("src1", "src2"))
    hits = retrieve(index, items.select(F.col("item_id").alias("question_id"), "question"), k=None, min_score=0.4)
    return hits.groupBy("question_id").agg(F.max("score").alias("best"), F.count("*").alias("n_hits"))


TOPIC_HITS_CTES = """positions as (
  select label, vec_id, unnest(embedding) as x,
    generate_subscripts(embedding, 1) as p from embeddings),
means as (select label, p, avg(cast(x as double)) as x from positions group by label, p),
topics as (select label, list(x order by p) as centre from means group by label),
hits as (
  select label as question_id, vec_id as match_id,
    round(list_cosine_similarity(centre, cast(embedding as double[])), 6) as score,
    row_number() over (partition by topics.label order by round(
      list_cosine_similarity(centre, cast(embedding as double[])), 6) desc, vec_id) as rank
  from (select vec_id, embedding from embeddings), topics
  where round(list_cosine_similarity(centre, cast(embedding as double[])), 6) >= 0.3
  qualify rank <= 5)"""


def topic_hits(spark: SparkSession, sf_dir: str, **options: int) -> DataFrame:
    """Every label's mean vector asks for its most similar vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    topics = similarity.label_centroids(vectors, "label", "embedding")
    return similarity.top_k(
        vectors,
        topics,
        min_score=0.3,
        corpus_id="vec_id",
        question_id="label",
        **options,
    )


@query(f"with {TOPIC_HITS_CTES} select * from hits")
def similarity_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topic_hits(spark, sf_dir)


@query(f"with {TOPIC_HITS_CTES} select * from hits")
def similarity_topk_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the questions in several blocks, as sets too large for one broadcast."""
    return topic_hits(spark, sf_dir, max_broadcast_floats=200)


@query(
    """with pairs as (
      select q.vec_id as question_id, c.vec_id as match_id,
        round(list_cosine_similarity(cast(q.embedding as double[]), cast(c.embedding as double[])), 6)
          as score
      from embeddings q, embeddings c),
    ranked as (
      select *, row_number() over (partition by question_id order by score desc, match_id) as rank
      from pairs where score >= 0.5)
    select * from ranked where rank <= 3"""
)
def similarity_topk_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector asks for its nearest ones, in blocks of questions."""
    vectors = table(spark, sf_dir, "embeddings")
    questions = vectors.select(F.col("vec_id").alias("question_id"), "embedding")
    return similarity.top_k(
        vectors, questions, k=3, min_score=0.5, corpus_id="vec_id", max_broadcast_floats=20_000
    )


IVF_CTES = """pairs as (
  select q.vec_id as question_id, c.vec_id as match_id,
    round(list_cosine_similarity(cast(q.embedding as double[]), cast(c.embedding as double[])), 6) as score
  from embeddings q, embeddings c where q.vec_id % 50 = 0),
hits as (
  select *, row_number() over (partition by question_id order by score desc, match_id) as rank
  from pairs where score >= 0.3 qualify rank <= 5)"""


def ivf_index(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """An index of all vectors, and the questions: those whose id is divisible by 50."""
    path = work_dir(spark, "ivf")
    vectors = table(spark, sf_dir, "embeddings")
    ivf.build_index(vectors, path, "vec_id")
    asked = vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("question_id"), "embedding")
    return path, asked


@query(f"with {IVF_CTES} select * from hits")
def topk_ivf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest cells first, then those cells that could hold a better row: exact."""
    path, asked = ivf_index(spark, sf_dir)
    return ivf.search(spark, path, asked, min_score=0.3, complete=True).hits


@query(
    f"""with {IVF_CTES}
    select count(distinct question_id) as questions, count(*) as wanted, true as enough from hits"""
)
def topk_ivf_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probed cells only, as many as the audit asks for; the recall of all questions is at least 0.95."""
    path, asked = ivf_index(spark, sf_dir)
    audit = asked.where(F.pmod(F.xxhash64("question_id"), F.lit(2)) == 0)
    found, _ = ivf.audited_search(spark, path, asked, audit, min_score=0.3)
    exact = ivf.search(spark, path, asked, min_score=0.3, complete=True)
    return ivf.recall(found.hits, exact.hits).agg(
        F.count("*").alias("questions"), F.sum("wanted").alias("wanted"), (F.avg("recall") >= 0.95).alias("enough")
    )


@query(
    f"""with {TOPIC_HITS_CTES}
    select question_id, string_agg({sql_clean("text")}, chr(10) || chr(10) order by rank)
      as context
    from hits join documents on match_id = doc_id group by question_id"""
)
def retrieval_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts found for a topic as one context."""
    docs = table(spark, sf_dir, "documents")
    texts = docs.select(F.col("doc_id").alias("match_id"), "text")
    found = topic_hits(spark, sf_dir).join(texts, "match_id")
    cleaned = with_clean_text(found, "text", "chunk_text")
    return context.assemble(cleaned, "question_id", "chunk_text", separator="\n\n")


@query(
    f"""with docs as (select doc_id, {sql_clean("text")} as text from documents),
    items as (select item_id, {sql_clean("text")} as text from benchmark),
    d as (select * from {weights_sql("docs", "doc_id", "text")}),
    q as (select * from {weights_sql("items", "item_id", "text")}),
    scores as (
      select item_id as question_id, doc_id as match_id, round(sum(d.weight * q.weight)
        / any_value(qn.norm) / any_value(dn.norm), 6) as score
      from d join q using (dim)
        join (select doc_id, sqrt(sum(weight * weight)) as norm from d group by doc_id) dn
          using (doc_id)
        join (select item_id, sqrt(sum(weight * weight)) as norm from q group by item_id) qn
          using (item_id)
      group by item_id, doc_id)
    select *, row_number() over (partition by question_id order by score desc, match_id)
      as rank
    from scores where score >= 0.5 qualify rank <= 5"""
)
def question_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item asks for the documents most like it, by the default embedding."""

    def embedded(name: str, key: str) -> DataFrame:
        rows = with_clean_text(spread(table(spark, sf_dir, name)), "text", "chunk_text")
        return embedding.embed_chunks(rows.select(key, "chunk_text"))

    return similarity.top_k(
        embedded("documents", "doc_id"),
        embedded("benchmark", "item_id"),
        min_score=0.5,
        corpus_id="doc_id",
        question_id="item_id",
    )


@query(
    """with positions as (
      select label, unnest(embedding) as x, generate_subscripts(embedding, 1) as p
      from embeddings),
    means as (select label, p, avg(cast(x as double)) as x from positions group by label, p),
    topics as (select label, list(x order by p) as centre from means group by label)
    select vec_id, round(list_cosine_similarity(centre, cast(embedding as double[])), 6)
      as own_score
    from embeddings join topics using (label)"""
)
def vector_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The similarity of each vector to the mean of its label, by built-in expressions."""
    vectors = table(spark, sf_dir, "embeddings")
    topics = similarity.label_centroids(vectors, "label", "embedding")
    topics = topics.withColumnRenamed("embedding", "centre")
    score = F.round(cosine(F.col("embedding"), F.col("centre")), 6)
    return vectors.join(topics, "label").select("vec_id", score.alias("own_score"))


@query(
    """with words as (
      select doc_id, unnest(list_filter(string_split_regex(lower(text), '[ \n\t\r]+'), lambda x: x <> '')) as term
      from documents),
    tfs as (select doc_id, term, count(*) as tf from words group by all),
    dfs as (select term, count(*) as df from tfs group by term),
    lengths as (select doc_id, count(term) as length from documents left join words using (doc_id) group by doc_id),
    size as (select count(*) as n, sum(length) / count(*) as mean from lengths),
    asked as (
      select distinct item_id as question_id,
        unnest(list_filter(string_split_regex(lower(text), '[ \n\t\r]+'), lambda x: x <> '')) as term
      from benchmark),
    scores as (
      select question_id, doc_id as match_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
        / (tf + 1.2 * (0.25 + 0.75 * length / mean))), 6) as score
      from asked join tfs using (term) join dfs using (term) join lengths using (doc_id), size
      group by question_id, doc_id)
    select *, row_number() over (partition by question_id order by score desc, match_id) as rank
    from scores qualify rank <= 5"""
)
def keyword_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item asks an inverted index of all documents for its best ones."""
    path = work_dir(spark, "keywords")
    keyword.build_index(table(spark, sf_dir, "documents"), path, "doc_id", "text", buckets=16)
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("question_id"), F.col("text").alias("question"))
    return keyword.search(spark, path, items)
