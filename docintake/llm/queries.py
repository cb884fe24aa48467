"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from docintake.llm import (
    chat, decontaminate, langid, packing, pii, quality, search, simhash, syncmers, tokens, trie,
    urls, warc,
)
from docintake.session import cut, prepare_python

VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
#: Learned are rows whose id's CRC-32 has another remainder.
HELD_OUT = "crc32(cast(doc_id AS string)) % 3 = 1"
RULES = [
    ("block", "net/"), ("allow", "example.net/en/"),
    ("block", "example.com/de/"), ("allow", "org/fr/"),
]


def table(spark, sf_dir, name):
    prepare_python(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chat_format(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    messages = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    done = chat.format_chats(messages.unionByName(extra))
    read = done.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn(
        "learned", chat.loss_text(F.col("segments"))
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def op2_token_counts(spark, sf_dir):
    counted = tokens.token_counts(table(spark, sf_dir, "documents"), vocabulary())
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op3_warc(spark, sf_dir):
    manifest = warc.write_packages(spark, table(spark, sf_dir, "pages"))
    return warc.read_packages(manifest, with_payload=False).select(
        F.col("id").try_cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").try_cast("bigint").alias("refers_to"),
    )


def op4_url_filter(spark, sf_dir):
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_syncmers(spark, sf_dir):
    pairs = syncmers.fingerprint_pairs(table(spark, sf_dir, "documents"))
    return pairs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        syncmers.sketch(F.col("own")).alias("fingerprint"),
        syncmers.sketch(F.col("edited_own")).alias("edited_fingerprint"),
        syncmers.likeness(F.col("own"), F.col("edited_own")).alias("near_edited"),
        syncmers.likeness(F.col("own"), F.col("next_own")).alias("near_next"),
        F.array_join(
            F.transform(
                syncmers.passages_in_place(F.col("own_kmers"), F.col("edited_kmers")),
                lambda p: F.concat_ws(":", p["start"], p["end"]),
            ),
            ",",
        ).alias("passages"),
    )


def op6_simhash(spark, sf_dir):
    marked = cut(simhash.fingerprints(table(spark, sf_dir, "documents")))
    return simhash.classes(marked).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op7_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.spans(docs, keep_text=False)

    def count(kind):
        n = F.size(F.filter("spans", lambda s: s["kind"] == kind))
        return n.cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.BASE],
        F.sha2(pii.joined(base), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


def quality_weights(spark, sf_dir, documents=None):
    """Weights fitted to the labelled rows outside the held-out third."""
    docs = table(spark, sf_dir, "documents") if documents is None else documents
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(f"NOT {HELD_OUT}")
    return quality.train(docs.select("doc_id", "text"), labels)


def op8_quality(spark, sf_dir):
    weights = quality_weights(spark, sf_dir)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score(docs, weights).select(
        "doc_id",
        F.expr(HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return packing.pack(cut(packing.pieces(docs, vocabulary())))


def op10_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.scan(docs, table(spark, sf_dir, "benchmark")).drop("text")
    hit = decontaminate.n_hit(F.col("hits"))
    return marked.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op11_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learned = langid.profiles(docs.where(f"NOT {HELD_OUT}"))
    found = langid.identify(docs.select("doc_id", "text"), learned)
    return found.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "lang_pred", "score")


def op12_lexical_search(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search.search(docs, table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark, sf_dir):
    return trie.prefix_trie(table(spark, sf_dir, "conversations")).drop("node")


QUERIES = {
    name: query for name, query in list(globals().items()) if name.startswith("op") and name[2].isdigit()
}
