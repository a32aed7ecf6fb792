"""The corpus operators applied to the given tables, with production parameters.

Each query takes (spark, folder of Parquet tables) and derives its digest columns from what the
operator returns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, toxicity
from .alignment import align_tokenizers
from .bpe import transcode
from .common import id_remainder, ship
from .conversations import damage, repair_report
from .decontaminate import contamination
from .exact_dedup import exact_dedup
from .line_dedup import line_report
from .minhash import near_duplicates
from .ppm import ppm_scores
from .repeats import cut_repeats
from .token_counts import token_counts
from .topk import scaled, top_products


def table(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    """The byte-level BPE vocabulary; installed at the same place on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def piece_path() -> str:
    """The sentence piece vocabulary, installed likewise."""
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op1_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder)
    model = toxicity.learn(docs, table(spark, folder, "labels"),
                           where=id_remainder(F.col("id"), 5) != 0)
    return toxicity.score(docs, model).select(
        "doc_id", (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder)
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    model = langid.learn(docs, where=~held_out)
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_report(table(spark, folder), copy_chars=1)


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder).select("doc_id", "text")
    outputs = {c: c for c in ("n_tokens", "ids_sha256", "decoded_sha256")}
    return transcode(docs, tokenizer_path(), outputs).drop("text")


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder), tokenizer_path())


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder)).drop("level", "name")


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(table(spark, folder), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        "contaminated")


def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    held_out = id_remainder(F.col("doc_id"), 7) == 2
    return ppm_scores(table(spark, folder), held_out, across=True)


def op10_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.end - s.start)
    return cut_repeats(table(spark, folder)).select(
        "doc_id", "n_bytes", removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_conversations(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations")
    return repair_report(damage(given), given)


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align_tokenizers(table(spark, folder), tokenizer_path(), piece_path())[0]


def op13_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").withColumn("vec", scaled(F.col("embedding")))
    return top_products(vectors, F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_toxicity": op2_toxicity,
    "op3_language_id": op3_language_id,
    "op4_line_dedup": op4_line_dedup,
    "op5_bpe": op5_bpe,
    "op6_token_counts": op6_token_counts,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_suffix_array": op10_suffix_array,
    "op11_conversations": op11_conversations,
    "op12_alignment": op12_alignment,
    "op13_exact_topk": op13_exact_topk,
}

FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

WORDS = f"regexp_extract_all({FOLD}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"

ORACLES = {
    "op1_minhash": f"""
        with recursive words as (
            select doc_id, list_filter(string_split_regex({FOLD}, '[\\x20\\x09-\\x0D]+'),
                                       lambda w: w <> '') as w
            from documents),
        shingles as (
            select distinct doc_id, array_to_string(w[s:s + least(len(w), 5) - 1], ' ') as x
            from (select *, unnest(range(1, len(w) - least(len(w), 5) + 2)) as s
                  from words where len(w) > 0)),
        sizes as (select doc_id, count(*) as n from shingles group by doc_id),
        pairs as (
            select a.doc_id as a, b.doc_id as b, count(*) as common
            from shingles a join shingles b using (x) where a.doc_id <> b.doc_id
            group by all),
        links as (
            select a, b from pairs join sizes p on p.doc_id = a join sizes q on q.doc_id = b
            where 100 * common >= 75 * (p.n + q.n - common)),
        reach as (
            select doc_id as a, doc_id as b from documents
            union
            select reach.a, links.b from reach join links on links.a = reach.b),
        least as (select a as doc_id, min(b) as component_id from reach group by a)
        select doc_id, coalesce(n, 0) as n_shingles, component_id,
               doc_id = component_id as kept
        from documents left join sizes using (doc_id) join least using (doc_id)""",
    "op7_exact_dedup": f"""
        with folded as (select doc_id, {FOLD} as t from documents),
        groups as (select t, max(doc_id) as keep_id, count(*) as group_size
                   from folded group by t)
        select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept,
               sha256(t) as text_sha256
        from folded join groups using (t)""",
    "op8_decontamination": f"""
        with item_words as (select item_id, {WORDS} as w from benchmark),
        sized as (select item_id, w, least(len(w), 10) as n from item_words where len(w) > 0),
        windows as (
            select distinct item_id, n, array_to_string(w[s:s + n - 1], ' ') as win
            from (select *, unnest(range(1, len(w) - n + 2)) as s from sized)),
        sizes as (select distinct n from windows),
        docs as (select doc_id, {WORDS} as w from documents),
        runs as (
            select doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') as win
            from (select *, unnest(range(1, len(w) - n + 2)) as s from docs cross join sizes)),
        hits as (select distinct doc_id, s, n, item_id from runs join windows using (n, win)),
        places as (
            select doc_id, count(distinct p) as n_hit
            from (select doc_id, unnest(range(s, s + n)) as p from hits) group by doc_id),
        listed as (
            select doc_id, count(*) as n_items,
                   string_agg(i, ',' order by encode(i)) as items
            from (select distinct doc_id, cast(item_id as varchar) as i from hits)
            group by doc_id)
        select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
               coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
               coalesce(n_hit, 0) > 0 as contaminated
        from docs d left join places using (doc_id) left join listed using (doc_id)""",
    "op13_exact_topk": """
        with given as (
            select vec_id, row_number() over () as place,
                   list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
            from embeddings
            where embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scores as (
            select q.vec_id as query_id, q.place, c.vec_id,
                   cast(coalesce(list_inner_product(q.v, c.v), 0) as bigint) as score
            from given q join given c on q.place <> c.place and len(q.v) = len(c.v)
            where q.vec_id % 50 = 0)
        select query_id, cast(rank as integer) as rank, vec_id, score
        from (select *, row_number() over (
                  partition by place order by score desc, vec_id nulls last) as rank
              from scores)
        where rank <= 5""",
}
