"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gamelake.llm.tables import table


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gamelake.llm import minhash

    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=4).select(
        "doc_id", "n_shingles", "component_id", "kept", "n_links")


def op2_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gamelake.llm import quality

    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", *quality.COUNTS, "base_failed", "kept", "anomaly")


def op3_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from gamelake.llm import langid

    docs = table(spark, sf_dir, "documents")
    out = langid.held_out(F.col("doc_id"))
    model = langid.learn(docs.filter(~out))
    return langid.identify(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gamelake.llm import nn_descent

    return nn_descent.nearest(table(spark, sf_dir, "embeddings"))


def op5_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gamelake.llm import warc

    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from gamelake.llm import line_dedup

    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"), direct=True).select(
        "doc_id", "n_lines", "n_removed", F.char_length("text").cast("long").alias("n_chars_kept"), F.md5("text").alias("text_md5"))


def op7_toxicity_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from gamelake.llm import toxicity

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = toxicity.held_out(F.col("doc_id"))
    model = toxicity.learn(docs.filter(~out), labels.filter(~out))
    return toxicity.score(docs, model).select("doc_id", out.alias("held_out"), "score", "predicted")


def url_history(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Captures and dated list entries derived from every page's id and URL.

    A capture's day follows from its page_id, an entry's days from a hash of
    its pattern: hosts, parent domains and first path steps are put on lists,
    taken off and put back.
    """
    from pyspark.sql import functions as F

    from gamelake.llm import url_filter

    start = F.lit("2024-01-01").cast("date")
    captures = pages.select("page_id", "url", F.date_add(start, (F.col("page_id") * 7919 % 730).cast("int")).alias("fetched"))
    host = url_filter.host_of(F.col("url"))
    hosts = pages.select(host.alias("h")).filter("h <> ''").distinct()
    parents = (hosts.filter(F.size(F.split("h", r"\.")) >= 3)
               .select(F.array_join(F.slice(F.split("h", r"\."), F.lit(2), F.size(F.split("h", r"\."))), ".").alias("h")).distinct())
    step = F.get(F.split(url_filter.path_of(F.col("url")), "/"), F.lit(1))
    steps = (pages.select(host.alias("h"), step.alias("s")).filter("h <> '' and s <> ''")
             .select(F.lower(F.concat("h", F.lit("/"), "s")).alias("h")).distinct())

    def number(df: DataFrame) -> DataFrame:
        return df.withColumn("n", F.conv(F.substring(F.md5("h"), 1, 8), 16, 10).cast("long"))

    def entry(df: DataFrame, name: str, kind: str, day, action: str) -> DataFrame:
        return df.select(F.lit(name).alias("list"), F.lit(kind).alias("kind"), F.col("h").alias("pattern"),
                         F.date_add(start, day.cast("int")).alias("day"), F.lit(action).alias("action"))

    n = F.col("n")
    hosts, parents, steps = number(hosts), number(parents), number(steps)
    spam, adult, ads, allow = hosts.filter("n % 3 = 0"), parents.filter("n % 4 = 1"), steps.filter("n % 6 = 2"), hosts.filter("n % 11 = 4")
    parts = [entry(spam, "spam", "host", n % 400, "add"), entry(spam.filter("n % 5 <> 0"), "spam", "host", n % 400 + 60 + n % 90, "remove"),
             entry(spam.filter("n % 7 = 0"), "spam", "host", n % 400 + 200 + n % 50, "add"),
             entry(adult, "adult", "host", n % 500, "add"), entry(adult, "adult", "host", n % 500 + 30 + n % 100, "remove"),
             entry(ads, "ads", "path", n % 600, "add"),
             entry(allow, "allow", "host", n % 300, "add"), entry(allow, "allow", "host", n % 300 + 100, "remove")]
    entries = parts[0]
    for part in parts[1:]:
        entries = entries.unionByName(part)
    return captures, entries


def op8_temporal_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gamelake.llm import url_filter

    captures, entries = url_history(table(spark, sf_dir, "pages"))
    return url_filter.judge(captures, entries)


def op9_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gamelake.llm import mixing

    return mixing.mix(table(spark, sf_dir, "documents"), target_entropy=0.95).select(
        "doc_id", "source", "mix_epoch", "mix_block", "mix_order")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from gamelake.llm import packing

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), added=True)


def op11_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gamelake.llm import lexical

    return lexical.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gamelake.llm import html_text

    return html_text.main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gamelake.llm import centroids

    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "pipeline": pipeline,
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_quality_forest": op2_quality_forest,
    "op3_language_spans": op3_language_spans,
    "op4_nn_descent": op4_nn_descent,
    "op5_warc_normaliser": op5_warc_normaliser,
    "op6_line_dedup": op6_line_dedup,
    "op7_toxicity_kernel": op7_toxicity_kernel,
    "op8_temporal_url_lists": op8_temporal_url_lists,
    "op9_temperature_mix": op9_temperature_mix,
    "op10_packing": op10_packing,
    "op11_reversed_search": op11_reversed_search,
    "op12_html_text": op12_html_text,
    "op13_centroid_clusters": op13_centroid_clusters,
}

OP8_SQL = r"""
with page as (
  select page_id, url, cast(date '2024-01-01' + cast(page_id * 7919 % 730 as integer) as date) as fetched,
    lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)) as host,
    regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) as path
  from pages
),
hosts as (select h, cast('0x' || substr(md5(h), 1, 8) as bigint) as n from (select distinct host as h from page where host <> '')),
parents as (
  select h, cast('0x' || substr(md5(h), 1, 8) as bigint) as n
  from (select distinct array_to_string(string_split(h, '.')[2:], '.') as h from hosts where len(string_split(h, '.')) >= 3)
),
steps as (
  select h, cast('0x' || substr(md5(h), 1, 8) as bigint) as n
  from (select distinct lower(host || '/' || string_split(path, '/')[2]) as h from page where host <> '' and string_split(path, '/')[2] <> '')
),
entry as (
  select 'spam' as list, 'host' as kind, h as pattern, n % 400 as d, true as adds from hosts where n % 3 = 0
  union all select 'spam', 'host', h, n % 400 + 60 + n % 90, false from hosts where n % 3 = 0 and n % 5 <> 0
  union all select 'spam', 'host', h, n % 400 + 200 + n % 50, true from hosts where n % 3 = 0 and n % 7 = 0
  union all select 'adult', 'host', h, n % 500, true from parents where n % 4 = 1
  union all select 'adult', 'host', h, n % 500 + 30 + n % 100, false from parents where n % 4 = 1
  union all select 'ads', 'path', h, n % 600, true from steps where n % 6 = 2
  union all select 'allow', 'host', h, n % 300, true from hosts where n % 11 = 4
  union all select 'allow', 'host', h, n % 300 + 100, false from hosts where n % 11 = 4
),
daily as (
  select list, kind, pattern, cast(date '2024-01-01' + cast(d as integer) as date) as day, bool_and(adds) as adds
  from entry group by all
),
keyed as (
  select page_id, fetched, 'host' as kind, array_to_string(labels[i:], '.') as pattern
  from (select page_id, fetched, string_split(host, '.') as labels, unnest(range(1, len(string_split(host, '.')) + 1)) as i from page where host <> '')
  union
  select page_id, fetched, 'path', lower(host || array_to_string(steps[1:i], '/'))
  from (select page_id, fetched, host, string_split(path, '/') as steps, unnest(range(2, len(string_split(path, '/')) + 1)) as i from page where host <> '')
),
last_word as (
  select k.page_id, k.kind, k.pattern, d.list, arg_max(d.adds, d.day) as holds
  from keyed k join daily d on d.kind = k.kind and d.pattern = k.pattern and d.day <= k.fetched
  group by all
),
active as (select * from last_word where holds),
per_page as (
  select page_id, count(*) as n_active, string_agg(distinct list, ',' order by list) as lists,
    bool_or(list <> 'allow') and not bool_or(list = 'allow') as blocked
  from active group by page_id
),
best as (
  select page_id, pattern from active
  qualify row_number() over (partition by page_id order by length(pattern) desc, pattern) = 1
)
select p.page_id, p.host, p.fetched, coalesce(a.n_active, 0) as n_active, coalesce(a.lists, '') as lists, b.pattern,
  coalesce(a.blocked, false) as blocked
from page p left join per_page a using (page_id) left join best b using (page_id)
"""

OP11_SQL = r"""
with found as (
  select d.doc_key, d.doc_id, unnest(regexp_extract_all(
    translate(d.text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select row_number() over () as doc_key, doc_id, text from documents) d
),
tf as (select doc_key, any_value(doc_id) as doc_id, term, count(*) as tf from found group by doc_key, term),
doc as (select doc_key, sum(tf)::bigint as n from tf group by doc_key),
whole as (select count(*) as docs, sum(n)::bigint as terms from doc),
item_term as (
  select distinct item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark
),
weight as (
  select t.term, floor(1000 * ln((2 * docs + 2) / (2 * t.df + 1)))::bigint as w
  from (select term, count(*) as df from tf group by term) t cross join whole
),
scored as (
  select i.item_id, tf.doc_key, any_value(tf.doc_id) as doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // terms)))))::bigint as score
  from item_term i join tf using (term) join weight using (term) join doc on doc.doc_key = tf.doc_key cross join whole
  group by i.item_id, tf.doc_key
),
ranked as (
  select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank
  from scored where score > 0
)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10
"""


def _round_sql(i: int) -> str:
    """CTEs of round ``i``: members (v row, cluster) by centroids ``c<i>``, then centroids ``c<i + 1>``."""
    return f"""
d{i} as materialized (
  select v.r, c.cluster, sum((v.x - c.x) * (v.x - c.x))::bigint as distance
  from v join c{i} c on c.i = v.i group by v.r, c.cluster
),
a{i} as materialized (
  select r, arg_min(cluster, (distance, cluster)) as cluster, min(distance) as distance from d{i} group by r
),
m{i} as (
  select a.cluster, v.i, floor_div(sum(v.x)::bigint, count(*)) as x from a{i} a join v on v.r = a.r group by a.cluster, v.i
),
c{i + 1} as materialized (
  select c.cluster, c.i, coalesce(m.x, c.x) as x from c{i} c left join m{i} m on m.cluster = c.cluster and m.i = c.i
)""".replace("floor_div(sum(v.x)::bigint, count(*))", "((sum(v.x) - ((sum(v.x) % count(*)) + count(*)) % count(*)) // count(*))::bigint")


OP13_SQL = f"""
with part as (
  select row_number() over () as r, vec_id, embedding from embeddings
),
long as (
  select r, vec_id, generate_subscripts(embedding, 1) as i, unnest(embedding)::double as x from part
),
kept as (
  select r from long group by r
  having count(*) = 64 and bool_and(coalesce(x > -2097152.0 and x < 2097152.0, false))
),
v as materialized (select r, vec_id, i, floor(64 * x)::bigint as x from long where r in (select r from kept)),
seeds as (
  select r, row_number() over (order by sha256('1:' || vec_id::varchar) nulls last, xs) - 1 as cluster
  from (select r, any_value(vec_id) as vec_id, list(x order by i) as xs from v group by r)
),
c0 as materialized (select s.cluster::int as cluster, v.i, v.x from seeds s join v on v.r = s.r where s.cluster < 16),
{','.join(_round_sql(i) for i in range(4))},
sums as (select cluster, sum(distance)::bigint as cluster_inertia from a3 group by cluster),
hashes as (select cluster, sha256(string_agg(x::varchar, ',' order by i)) as centroid_sha256 from c3 group by cluster)
select v.vec_id, a.cluster, a.distance, s.cluster_inertia, (select sum(distance)::bigint from a3) as inertia, h.centroid_sha256
from a3 a join (select distinct r, vec_id from v) v on v.r = a.r join sums s on s.cluster = a.cluster join hashes h on h.cluster = a.cluster
"""

ORACLE: dict[str, str] = {"op8_temporal_url_lists": OP8_SQL, "op11_reversed_search": OP11_SQL, "op13_centroid_clusters": OP13_SQL}
