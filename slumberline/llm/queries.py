"""The registered queries of this package, each over the whole of its table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slumberline.llm import chat, decontaminate, html_text, mixing, near_dups, pii, quality, sharding, simhash, spelling
from slumberline.llm import substring_dedup, suffix_dedup, whitening
from slumberline.llm.arithmetic import mixed32_sql

# The conversation that op6 adds: control strings inside texts.
PROBE_CONVERSATION = -7
PROBE_TEXT = r"\### Assistant: </turn> ok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[pii.count_of(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.span_list(F.col("base")), 256).alias("base_sha256"),
        pii.span_list(F.concat("base", "added")).alias("spans"),
    )


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dups.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "kept")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeated_windows(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeated_strings(table(spark, sf_dir, "documents"))
    spans = F.size("removed").cast("bigint").alias("n_spans")
    return kept.select("doc_id", "n_bytes", "n_removed", spans, F.sha2("kept", 256).alias("kept_sha256"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = [(PROBE_CONVERSATION, turn, role, PROBE_TEXT) for turn, role in enumerate(("user", "assistant"))]
    rows = rows.unionByName(spark.createDataFrame(probe, "conv_id long, turn long, role string, text string"))
    formatted = chat.format_log(chat.rows_as_events(rows))
    turns = chat.read_back(F.col("formatted"))
    read = formatted.select(
        "conv_id",
        "formatted",
        turns.alias("turns"),
        chat.masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss"),
    )
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    sharded = sharding.shard(rows, ties=("size", "text_crc32"))
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    longest = F.array_max(F.col("tiles")["words"]).alias("longest_tile")
    return found.select("doc_id", "item_id", "coverage", F.size("tiles").cast("bigint").alias("n_tiles"), longest)


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.assess(docs, model, ["doc_id"])


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_mixing": op5_mixing,
    "op6_chat": op6_chat,
    "op7_sharding": op7_sharding,
    "op8_decontamination": op8_decontamination,
    "op9_html": op9_html,
    "op10_quality": op10_quality,
    "op11_simhash": op11_simhash,
    "op12_whitening": op12_whitening,
    "op13_spelling": op13_spelling,
}

_PLACE = (
    f"({mixed32_sql('told', mixing.HASH_KEYS[0])} << {mixing.BITS - 32}) | "
    f"({mixed32_sql('told', mixing.HASH_KEYS[1])} >> {64 - mixing.BITS})"
)

ORACLE_SQL: dict[str, str] = {
    "op5_mixing": f"""
        WITH named AS (
            SELECT *, xor(coalesce(doc_id, -1) & {(1 << 62) - 1}, ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT) AS told
            FROM documents
        ), sized AS (
            SELECT doc_id, source, {_PLACE} AS place,
                   coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
            FROM named
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   ([3, 1, 2])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
            FROM sized GROUP BY source
        ), ranked AS (
            SELECT source, source_size, weight, 2 * source_size AS cap,
                   (sum(source_size) OVER ())::DOUBLE * 1.5 AS budget,
                   coalesce(sum(2 * source_size) OVER (need ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS given,
                   (sum(weight) OVER (need ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS open_weight
            FROM sources WINDOW need AS (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST)
        ), rated AS (
            SELECT *, (budget - given) / open_weight AS rest, cap <= (budget - given) / open_weight * weight AS capped FROM ranked
        ), planned AS (
            SELECT source, source_size,
                   CASE WHEN capped THEN cap::DOUBLE
                        ELSE (SELECT arg_min(rest, given) FROM rated WHERE NOT capped) * weight END AS target
            FROM rated
        ), whole AS (
            SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 2)::BIGINT ELSE 0 END AS whole FROM planned
        ), running AS (
            SELECT d.doc_id, d.size, w.source_size, w.target, w.whole, w.target - w.whole * w.source_size AS budget,
                   sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place)::BIGINT AS upto
            FROM sized d JOIN whole w ON d.source IS NOT DISTINCT FROM w.source
        )
        SELECT doc_id, size, source_size, target,
               (size * (whole + CASE WHEN whole < 2 AND 2 * (upto - size) + size <= 2 * budget THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM running""",
    "op6_chat": f"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT {PROBE_CONVERSATION}, 0, 'user', '{PROBE_TEXT}'
            UNION ALL SELECT {PROBE_CONVERSATION}, 1, 'assistant', '{PROBE_TEXT}'
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length('<turn:>') + length('</turn>') + 1
                   + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'))
                   + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')))::BIGINT AS formatted_chars
        FROM rows GROUP BY conv_id""",
}
