"""The registered queries of these operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    ball_tree,
    jaccard,
    language,
    lines,
    mixing,
    multi_index,
    packing,
    ranked,
    secrets,
    sharding,
    url_trees,
    weak_rules,
    whitening,
)
from millrace.llm.common import table


URL_RULES = [
    url_trees.rule("allow", "com/"),
    url_trees.rule("block", "example.com/en/"),
    url_trees.rule("allow", "www.example.com/en/"),
    url_trees.rule("block", "net/es/"),
    url_trees.rule("block", "net/fr/"),
]
SOURCE_WEIGHTS = [3.0, 1.0, 2.0]


def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_trees.judged(table(spark, folder, "pages"), URL_RULES)


def op2_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.mixed(table(spark, folder, "documents"), SOURCE_WEIGHTS)
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def held_out() -> Column:
    """Documents that the language model may not learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def may_learn() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 != 0


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    net = language.learn_languages(documents, may_learn())
    found = language.identify(documents, net)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op4_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, folder, "documents"))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each line that goes."""
    return lines.later_matches(table(spark, folder, "documents"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_top_k_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = ball_tree.quantized(table(spark, folder, "embeddings"))
    return ball_tree.top_k(vectors, F.col("vec_id") % 50 == 0)


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    rows = sharding.with_slots(sharding.into_shards(table(spark, folder, "documents")))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = weak_rules.judged(table(spark, folder, "documents"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.col("good")).alias("kept"),
        "quality",
    )


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, folder, "documents"))
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *(count(k) for k in secrets.BASE), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans")
    )


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.top_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = whitening.scaled(table(spark, folder, "embeddings"))
    fitted = whitening.fit(rows)
    error = whitening.identity_error(rows, fitted)
    each = whitening.whitened(rows, fitted).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    explained = F.array(*map(F.lit, fitted.explained)).cast("array<double>")
    return each.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("place") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op13_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = multi_index.near_duplicates(table(spark, folder, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_source_mixing": op2_source_mixing,
    "op3_language_id": op3_language_id,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_line_dedup": op5_line_dedup,
    "op6_packing": op6_packing,
    "op7_top_k_search": op7_top_k_search,
    "op8_sharding": op8_sharding,
    "op9_quality_rules": op9_quality_rules,
    "op10_secrets": op10_secrets,
    "op11_ranked_search": op11_ranked_search,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_embedding_near_dedup": op13_embedding_near_dedup,
    "pipeline": pipeline,
}
ORACLE_SQL: dict[str, str] = {
    "op4_ngram_jaccard_join": r"""
        with recursive words as (
            select doc_id, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
            from documents
        ), shingles as (
            select distinct doc_id, unnest(case
                when len(w) = 0 then []
                when len(w) < 5 then [array_to_string(w, ' ')]
                else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as shingle
            from words
        ), sizes as (
            select doc_id, count(*) as n from shingles group by doc_id
        ), common as (
            select x.doc_id as a, y.doc_id as b, count(*) as c
            from shingles x join shingles y on x.shingle = y.shingle and x.doc_id <> y.doc_id
            group by all
        ), links as (
            select a, b from common
            join sizes x on x.doc_id = a join sizes y on y.doc_id = b
            where 100 * c >= 75 * (x.n + y.n - c)
        ), reach as (
            select doc_id, doc_id as other from documents
            union
            select links.a, reach.other from reach join links on links.b = reach.doc_id
        )
        select d.doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, min(other) as component_id
        from documents d join reach r on r.doc_id = d.doc_id left join sizes s on s.doc_id = d.doc_id
        group by d.doc_id
    """,
    "op7_top_k_search": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v
            from embeddings
            where vec_id is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), scored as (
            select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
            from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
            where q.vec_id % 50 = 0
        )
        select query_id, rank::int as rank, vec_id, score
        from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
        where rank <= 5
    """,
    "op11_ranked_search": r"""
        with terms as (
            select doc_id, row_id, unnest(t) as term from (
                select doc_id, row_number() over () as row_id, regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t
                from documents where text is not null)
        ), lengths as (
            select row_id, any_value(doc_id) as doc_id, count(*) as n from terms group by row_id
        ), totals as (
            select count(*) as total, sum(n)::bigint as length from lengths
        ), postings as (
            select row_id, term, count(*) as tf from terms group by all
        ), weights as (
            select term, floor(1000 * ln((2 * any_value(total) + 2)::double / (2 * count(*) + 1)::double))::bigint as w
            from postings, totals group by term
        ), items as (
            select distinct item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from benchmark where text is not null
        ), scored as (
            select item_id, row_id, any_value(l.doc_id) as doc_id,
                sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * total) // length))))::bigint as score
            from items join postings using (term) join weights using (term) join lengths l using (row_id), totals
            group by item_id, row_id
        )
        select item_id, rank::int as rank, doc_id, score
        from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0)
        where rank <= 50
    """,
    "op13_embedding_near_dedup": r"""
        with recursive v as (
            select row_number() over () as row_id, vec_id, label, list_transform(embedding, lambda x: x::double) as v,
                label is not null and coalesce(len(embedding), 0) > 0
                    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
                    and len(list_filter(embedding, lambda x: x <> 0)) > 0 as usable
            from embeddings
        ), lengths as (
            select row_id, vec_id, label, v, sqrt(list_dot_product(v, v)) as norm from v where usable
        ), links as (
            select a.row_id as a, b.row_id as b
            from lengths a join lengths b on a.label = b.label and a.row_id <> b.row_id and len(a.v) = len(b.v)
            where list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.93
        ), counted as (
            select a, count(*) as n from links group by a
        ), reach as (
            select row_id, row_id as other from v
            union
            select links.a, reach.other from reach join links on links.b = reach.row_id
        )
        select x.vec_id, coalesce(any_value(n), 0)::bigint as n_links, min(y.vec_id) as component_id,
            x.vec_id is not distinct from min(y.vec_id) as kept
        from v x join reach r on r.row_id = x.row_id join v y on y.row_id = r.other left join counted on a = x.row_id
        group by x.row_id, x.vec_id
    """,
}
