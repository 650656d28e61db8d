"""One registered query per text operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from filingloom.llm import (
    alignment,
    backoff,
    chat,
    contamination,
    html,
    language,
    lengths,
    mixing,
    quality,
    secrets,
    simhash,
    topk,
    variants,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_mix_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.with_copies(docs).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "source",
        "copies",
    )


@query
def op4_secret_spans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.with_spans(docs).select("doc_id", "spans")
    base = [kind.name for kind in secrets.BASE_KINDS]
    own = F.filter("spans", lambda s: s["kind"].isin(base))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in base),
        F.sha2(listed(own), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query
def op10_chat_format(spark, sf_dir):
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], told.schema)
    return chat.conversation_digests(chat.formatted_turns(told.unionByName(extra)))


@query
def op2_language_codes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = language.held_out()
    model = language.fit(docs, ~held)
    told = language.with_language(docs.select("doc_id", "text"), model)
    return told.select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")


@query
def op7_token_lengths(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text")
    return lengths.context_report(lengths.summed(docs))


@query
def op6_simhash_groups(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op8_main_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    text = F.col("text")
    return html.with_main_text(pages).select("page_id", "url", text, F.char_length(text).cast("long").alias("n_chars"))


@query
def op9_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return quality.judged(docs).drop("lang", "source")


@query
def op5_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    found = contamination.contaminated(docs, items)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
        "n_near",
    )


@query
def op3_backoff_score(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = backoff.held_out()
    found = backoff.scored(docs, ~held)
    return found.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op12_max_score(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", topk.whole_components(F.col("embedding")).alias("vector"))
    return topk.top_rows(vectors, F.col("vec_id") % 20 == 0)


@query
def op11_token_links(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    found = alignment.encoded(docs).withColumn("groups_sha256", digest).drop("groups")
    return alignment.with_counts(found)


@query
def op13_spelling_forms(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants.grouped(variants.vocabulary(docs, one_in=199))
