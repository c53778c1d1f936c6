"""The operators as named queries over the check tables, with their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voidage.llm import codes, quality, toxicity
from voidage.llm.common import documents
from voidage.llm.exact import exact_dedup
from voidage.llm.fingerprints import with_edits
from voidage.llm.infill import fill_in_middle, restored
from voidage.llm.near import near_duplicates
from voidage.llm.packing import pack, token_pieces
from voidage.llm.pieces import decode, encode
from voidage.llm.preferences import against_neighbour, as_arrays, format_pairs
from voidage.llm.pseudonyms import pseudonymise
from voidage.llm.recompress import without_repeats
from voidage.llm.substrings import without_repeats as without_byte_repeats


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts of ``documents``; the largest doc_id stays."""
    rows = exact_dedup(documents(spark, sf_dir))
    return rows.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of ``documents`` with 85 of 100 three-word shingles in common."""
    rows = near_duplicates(documents(spark, sf_dir))
    return rows.select("doc_id", "n_shingles", "component_id", "kept")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` without bytes that 400-byte strings with another occurrence cover."""
    rows = without_byte_repeats(documents(spark, sf_dir))
    return rows.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with personal data replaced by pseudonyms."""
    docs = documents(spark, sf_dir)
    return pseudonymise(docs).select("doc_id", "text")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text of ``documents``, of its edited text, and how like they are."""
    rows = with_edits(documents(spark, sf_dir))
    as_text = {c: F.base64(c) for c in ("fingerprint", "edited_fingerprint")}
    return rows.withColumns(as_text)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` without words that 13-word windows of smaller documents cover."""
    rows = without_repeats(documents(spark, sf_dir))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with its neighbour's last answer, as prompt and masked completions."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = format_pairs(against_neighbour(as_arrays(turns)))
    as_text = lambda c: F.array_join(
        F.transform(c, lambda s: F.concat_ws(":", s["start"].cast("string"), s["length"].cast("string"))), ","
    )
    return rows.withColumns({c: as_text(c) for c in ("chosen_mask", "rejected_mask")})


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` encoded, and decoded again from its ids."""
    rows = decode(encode(documents(spark, sf_dir)))
    return rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` scored by a model that learned from labels that are not held out."""
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_windows",
        "top_window",
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into few sequences of 4096 tokens."""
    return pack(token_pieces(documents(spark, sf_dir)))


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` cut in three and put together again, and rebuilt from that."""
    rows = fill_in_middle(documents(spark, sf_dir))
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector of ``embeddings`` as sixteen indexes, with its error and that of its label."""
    rows, books = codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return rows.select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(None if books is None else codes.books_sha256(books)).cast("string").alias("codebooks_sha256"),
    )


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` scored by a model that learned from labels that are not held out."""
    docs = documents(spark, sf_dir)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_near_dedup": op2_near_dedup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_pii": op4_pii,
    "op5_fingerprints": op5_fingerprints,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_preferences": op7_preferences,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_toxicity": op9_toxicity,
    "op10_packing": op10_packing,
    "op11_infill": op11_infill,
    "op12_codes": op12_codes,
    "op13_quality": op13_quality,
}


def _round(number: int) -> str:
    """One assignment of all parts, and the codebooks after it."""
    return f"""
        near{number} AS (
            SELECT p.row, p.part, min(list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64
                                      + c.entry) AS x
            FROM pieces p JOIN books{number} c USING (part) GROUP BY ALL
        )"""


def _moved(number: int) -> str:
    return f"""
        means{number} AS (
            SELECT part, entry, place, floor(sum(x) / count(*))::BIGINT AS x
            FROM (SELECT p.part, n.x % 64 AS entry, unnest(p.v) AS x, unnest(range(1, len(p.v) + 1)) AS place
                  FROM pieces p JOIN near{number} n USING (row, part))
            GROUP BY ALL
        ), books{number + 1} AS (
            SELECT c.part, c.entry, coalesce(m.v, c.v) AS v
            FROM books{number} c LEFT JOIN (SELECT part, entry, list(x ORDER BY place) AS v FROM means{number} GROUP BY ALL) m
            USING (part, entry)
        )"""

ORACLES: dict[str, str] = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op7_preferences": """
        WITH t AS (
            SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k
            FROM conversations
        ), c AS (
            SELECT conv_id, count(*) AS n, max(CASE WHEN role = 'assistant' THEN k END) AS l
            FROM t GROUP BY conv_id
        ), a AS (
            SELECT c.conv_id, c.n, c.l, t.text AS answer FROM c LEFT JOIN t ON t.conv_id = c.conv_id AND t.k = c.l
        ), p AS (
            SELECT a.conv_id, b.answer AS other,
                   CASE WHEN a.l IS NULL THEN a.n WHEN a.answer = b.answer THEN a.l ELSE a.l - 1 END AS shared,
                   b.answer IS NOT NULL AND (a.l IS NULL OR a.answer <> b.answer) AS differs
            FROM a LEFT JOIN a AS b ON b.conv_id = xor(a.conv_id, 1)
        ), r AS (
            SELECT t.conv_id, t.k, t.role, t.text, p.shared,
                   '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10) AS piece
            FROM t JOIN p USING (conv_id)
        ), s AS (
            SELECT *, coalesce(sum(length(piece)) OVER (
                       PARTITION BY conv_id, k > shared ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                       + length(role) + 5 AS start
            FROM r
        ), g AS (
            SELECT conv_id,
                   coalesce(string_agg(piece, '' ORDER BY k) FILTER (k <= shared), '') AS prompt,
                   coalesce(string_agg(piece, '' ORDER BY k) FILTER (k > shared), '') AS chosen_text,
                   coalesce(string_agg(start::BIGINT || ':' || (length(text) + 7), ',' ORDER BY k)
                            FILTER (k > shared AND role = 'assistant'), '') AS chosen_mask
            FROM s GROUP BY conv_id
        )
        SELECT g.conv_id, g.prompt, p.shared::INTEGER AS n_prompt_turns, g.chosen_text,
               CASE WHEN p.differs THEN '<|assistant|>' || chr(10) || p.other || '<|end|>' || chr(10) ELSE '' END
                   AS rejected_text,
               g.chosen_mask,
               CASE WHEN p.differs THEN '14:' || (length(p.other) + 7) ELSE '' END AS rejected_mask
        FROM g JOIN p USING (conv_id)
    """,
    "op11_infill": """
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS h FROM documents
        ), h AS (
            SELECT *, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
                   ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4,
                   regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS tokens
            FROM d
        ), c AS (
            SELECT *, len(tokens) AS n, least(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS i,
                   greatest(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS j
            FROM h
        ), f AS (
            SELECT *, array_to_string(tokens[:i], '') AS prefix, array_to_string(tokens[i + 1:j], '') AS middle,
                   array_to_string(tokens[j + 1:], '') AS suffix,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                             OR h3 % 100 >= 90 OR h3 IS NULL THEN 'plain'
                        WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM c
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM f
    """,
    "op12_codes": f"""
        WITH kept AS (
            SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label,
                   list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v
            FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), pieces AS (
            SELECT row, part, v[part * (len(v) // 16) + 1:(part + 1) * (len(v) // 16)] AS v FROM kept, range(16) r(part)
        ), books0 AS (SELECT part, row - 1 AS entry, v FROM pieces WHERE row <= 64),
        {_round(0)}, {_moved(0)}, {_round(1)}, {_moved(1)}, {_round(2)},
        codes AS (
            SELECT row, string_agg(printf('%02x', (x % 64)::INTEGER), '' ORDER BY part) AS code, sum(x // 64)::BIGINT AS error
            FROM near2 GROUP BY row
        ), books AS (
            SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM books2
        )
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
        FROM codes JOIN kept USING (row), books
    """,
}
