"""The operators as queries over the given tables, and the same in SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roomledger.llm import (
    bpe, decontamination, extraction, jaccard, language, manifest, mixing, packed, pseudonyms, repetition, sharding, tokencounts, whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def private_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(_table(spark, sf_dir, "documents").select("doc_id", "text"), "a key of the corpus")


def sharding_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_documents(docs).select("doc_id", *sharding.OWN)


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(_table(spark, sf_dir, "pages"))


def repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetition.repetition_rules(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", *repetition.FIGURES[:5], "base_failed", "kept")


def separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.token_counts(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed.token_files(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.taken_words(docs).drop("source")


def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(_table(spark, sf_dir, "embeddings"))


def tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.code_both_ways(_table(spark, sf_dir, "documents"))


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.audit(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": language_id,
    "op2_jaccard_join": jaccard_join,
    "op3_pseudonyms": private_pseudonyms,
    "op4_template_leaks": template_leaks,
    "op5_sharding": sharding_slots,
    "op6_page_text": page_text,
    "op7_repetition_rules": repetition_rules,
    "op8_separator_scan": separator_scan,
    "op9_simple8b_files": token_files,
    "op10_source_mix": source_mix,
    "op11_whitening": embedding_whitening,
    "op12_tree_bpe": tree_bpe,
    "op13_merkle_manifest": merkle_manifest,
}

TEMPLATE_SQL = r"""
    regexp_replace(regexp_replace(text, '([\p{L}\p{N},;:)] )\p{Lu}\p{Ll}+', '\1ⓐ', 'g'), '([\p{L}\p{N},;:)ⓐ] )\p{Lu}\p{Ll}+', '\1ⓐ', 'g')
"""


def _merkle_sql(levels: int = 6, above: int = 4) -> str:
    """The manifest in SQL for up to 16^levels documents a source and 16^above sources.

    ``k`` is the source with a sign before it, and empty for null, so that
    null comes first; crc32 folds the digits of the id, eight shifts a byte.
    """
    def field(name: str) -> str:
        return f"coalesce(strlen({name}::VARCHAR)::VARCHAR || ':' || {name}::VARCHAR, '-')"

    def tree(name: str, group: str, depth: int) -> str:
        return "".join(f""", {name}r{k} AS (
            SELECT {group}, pos // 16 AS up, n, list(digest ORDER BY pos) AS run FROM {name}{k} GROUP BY ALL
        ), {name}{k + 1} AS (
            SELECT {group}, up AS pos, (n + 15) // 16 AS n,
                   CASE WHEN n > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS digest FROM {name}r{k}
        )""" for k in range(depth))

    def climb(name: str, group: str, depth: int, start: str) -> str:
        """Fold every row through the runs of its tree, gathering siblings."""
        steps, before = "", start
        for k in range(depth):
            own = f"w.pos // {16 ** k} % 16"
            steps += f""", {name}w{k} AS (
            SELECT w.* EXCLUDE (siblings, folded),
                   CASE WHEN r.n > 1 THEN siblings || array_to_string(run[1:{own}] || run[{own} + 2:], '') ELSE siblings END AS siblings,
                   CASE WHEN r.n > 1 THEN sha256(array_to_string(run[1:{own}] || [folded] || run[{own} + 2:], '')) ELSE folded END AS folded
            FROM {before} w JOIN {name}r{k} r ON {' AND '.join([f'w.{group} = r.{group}', f'w.pos // {16 ** (k + 1)} = r.up'])}
        )"""
            before = f"{name}w{k}"
        return steps

    first, lowered = (f"sha256({' || '.join(field(c) if c != 'text' else field(t) for c in manifest.FIELDS)})"
                      for t in ("text", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"))
    shifts = ", ".join(["-1"] * 8)
    return f"""
        WITH hashed AS (
            SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '+' || source END AS k, {first} AS leaf, {lowered} AS lowered,
                   xor(list_reduce(flatten([[4294967295], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
                       lambda c: [ascii(c)::BIGINT, {shifts}]))]),
                       lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295) AS crc
            FROM documents
        ), ranked AS (
            SELECT *, CASE WHEN crc % 5 = 0 THEN lowered ELSE leaf END AS shown,
                   row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY k) AS n
            FROM hashed
        ), s0 AS (SELECT k, pos, n, leaf AS digest FROM ranked){tree("s", "k", levels)}
        , a0 AS (SELECT 0 AS g, k, row_number() OVER (ORDER BY k) - 1 AS pos, count(*) OVER () AS n, digest FROM s{levels}){tree("a", "g", above)}
        , start AS (SELECT doc_id, k, pos, leaf, shown AS folded, '' AS siblings FROM ranked){climb("s", "k", levels, "start")}
        , middle AS (
            SELECT w.* EXCLUDE (pos), a0.g, a0.pos, a0.digest AS subroot FROM sw{levels - 1} w JOIN a0 USING (k)
        ){climb("a", "g", above, "middle")}
        SELECT doc_id, leaf, subroot, a{above}.digest AS root, sha256(siblings) AS proof_sha256, folded AS folded_root,
               folded = a{above}.digest AS verified
        FROM aw{above - 1} CROSS JOIN a{above}
    """


ORACLES = {
    # No item of the given benchmark has a placeholder, so none of its slots needs comparing here.
    "op4_template_leaks": rf"""
        WITH named AS (
            SELECT 'd' AS kind, doc_id AS id, {TEMPLATE_SQL} AS t FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)
            UNION ALL SELECT 'b', item_id, {TEMPLATE_SQL} FROM benchmark WHERE text IS NOT NULL
        ), joined AS (
            SELECT kind, id, regexp_replace(regexp_replace(t, '([0-9])[.,]([0-9])', '\1\2', 'g'), '([0-9])[.,]([0-9])', '\1\2', 'g') AS t FROM named
        ), counted AS (
            SELECT kind, id, row_number() OVER () AS r, regexp_replace(regexp_replace(regexp_replace(
                t, '([0-9] ?)(?:{decontamination.UNITS})([^\p{{L}}]|$)', '\1 ⓤ \2', 'g'), '([0-9])%', '\1 ⓤ ', 'g'), '[0-9]+', ' ⓝ ', 'g') AS t FROM joined
        ), worded AS (
            SELECT kind, id, r, list_filter(string_split_regex(lower(t), '[^\p{{L}}\p{{N}}ⓝⓤⓐ]+'), lambda w: w <> '') AS words FROM counted
        ), windows AS (
            SELECT kind, id, r, i, words[i:i + 5] AS run FROM (
                SELECT kind, id, r, words, unnest(generate_series(1, len(words) - 5)) AS i FROM worded)
        ), literal AS (
            SELECT kind, id, r, i, array_to_string(run, ' ') AS run FROM windows
            WHERE len(list_filter(run, lambda w: w IN ('ⓝ', 'ⓤ', 'ⓐ'))) <= 2
        ), items AS (
            SELECT id AS item_id, run, count(*) OVER (PARTITION BY id) AS n_windows FROM literal WHERE kind = 'b'
        ), matched AS (
            SELECT d.id AS doc_id, d.r, item_id, n_windows, count(*) AS n_matched
            FROM (SELECT DISTINCT id, r, run FROM literal WHERE kind = 'd') d JOIN items USING (run) GROUP BY ALL
        )
        SELECT doc_id, item_id, n_matched::BIGINT AS n_matched, n_windows::BIGINT AS n_windows, n_matched::DOUBLE / n_windows AS covered
        FROM matched WHERE n_matched::DOUBLE / n_windows >= 0.4
    """,
    "op7_repetition_rules": r"""
        WITH texts AS (
            SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), short AS (
            SELECT r, i, array_to_string(words[i:i + 4], ' ') AS run
            FROM (SELECT r, words, unnest(generate_series(1, len(words) - 4)) AS i FROM texts)
        ), covered AS (
            SELECT r, count(DISTINCT p) AS n FROM (
                SELECT r, unnest(generate_series(i, i + 4)) AS p
                FROM (SELECT *, count(*) OVER (PARTITION BY r, run) AS times FROM short) WHERE times > 1
            ) GROUP BY r
        ), long AS (
            SELECT DISTINCT r FROM (
                SELECT r, array_to_string(words[i:i + 50], ' ') AS run
                FROM (SELECT r, words, unnest(generate_series(1, len(words) - 50)) AS i FROM texts)
            ) GROUP BY r, run HAVING count(*) > 1
        ), lines AS (
            SELECT r, sum(n - 1) AS n FROM (
                SELECT r, line, count(*) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts)
                WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r, line
            ) GROUP BY r
        ), base AS (
            SELECT doc_id, len(words)::BIGINT AS n_words,
                   length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
                   len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                   coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
                   long.r IS NOT NULL AS too_long
            FROM texts LEFT JOIN covered USING (r) LEFT JOIN lines USING (r) LEFT JOIN long USING (r)
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
               NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT too_long AS kept
        FROM base
    """,
    "op10_source_mix": r"""
        WITH sized AS (
            SELECT doc_id, source, md5('mix-' || coalesce(doc_id::VARCHAR, '')) AS key,
                   coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
            FROM documents
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   (ARRAY[5.0, 2.0, 1.0])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
            FROM sized GROUP BY source
        ), levels AS (
            SELECT *, 2.0::DOUBLE * source_size / weight AS meets,
                   (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0))
                   / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
            FROM sources
            WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), targets AS (
            SELECT source, source_size,
                   least(2.0::DOUBLE * source_size,
                         coalesce((SELECT arg_min(level, meets) FROM levels WHERE level <= meets) * weight,
                                  2.0::DOUBLE * source_size)) AS target
            FROM levels
        ), placed AS (
            SELECT doc_id, size, source_size, target, s.source, row_number() OVER () AS r,
                   (sum(size) OVER (PARTITION BY s.source ORDER BY key, size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT - size AS start
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
        ), shares AS (
            SELECT source, ceil(floor(target) / 256)::BIGINT AS slots,
                   sum(ceil(floor(target) / 256)::BIGINT) OVER (ORDER BY source NULLS LAST) AS upto,
                   sum(ceil(floor(target) / 256)::BIGINT) OVER () AS total
            FROM targets
        ), points AS (
            SELECT unnest(range((SELECT max(total) FROM shares)::BIGINT)) AS position
        ), fallen AS (
            -- the golden ratio times 1, 2, 3 ...; the first digits of large multiples apart, so that none is lost to rounding
            SELECT position, source, slots, row_number() OVER (PARTITION BY source ORDER BY position) - 1 AS block
            FROM points JOIN shares
            ON fmod(((position + 1) >> 20)::DOUBLE * fmod(0.6180339887498949::DOUBLE * 1048576, 1.0::DOUBLE)
                    + ((position + 1) % 1048576) * 0.6180339887498949::DOUBLE, 1.0::DOUBLE) >= (upto - slots)::DOUBLE / total::DOUBLE
            AND fmod(((position + 1) >> 20)::DOUBLE * fmod(0.6180339887498949::DOUBLE * 1048576, 1.0::DOUBLE)
                    + ((position + 1) % 1048576) * 0.6180339887498949::DOUBLE, 1.0::DOUBLE) < upto::DOUBLE / total::DOUBLE
        ), slots AS (
            SELECT source, block, position FROM fallen WHERE block < slots
            UNION ALL
            SELECT s.source, b.block, s.total::BIGINT + b.block FROM (
                SELECT source, slots, total, unnest(range(slots)) AS block FROM shares) b JOIN shares s ON s.source IS NOT DISTINCT FROM b.source
            WHERE b.block >= (SELECT count(*) FROM fallen f WHERE f.source IS NOT DISTINCT FROM b.source)
        ), pieces AS (
            SELECT r, turn * source_size + start AS low, least(turn * source_size + start + size, floor(target))::BIGINT AS high, source
            FROM placed, (VALUES (0), (1)) AS turns (turn)
        ), held AS (
            SELECT r, count(*) AS n_slots, min(position) AS first_position,
                   sum(least(high, (p.block + 1) * 256) - greatest(low, p.block * 256)) AS taken
            FROM (SELECT r, low, high, source, unnest(range(low // 256, (high - 1) // 256 + 1)) AS block FROM pieces WHERE low < high) p
            JOIN slots s ON s.source IS NOT DISTINCT FROM p.source AND s.block = p.block
            GROUP BY r
        )
        SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken, first_position::BIGINT AS first_position,
               coalesce(n_slots, 0)::BIGINT AS n_slots
        FROM placed LEFT JOIN held USING (r)
    """,
    "op13_merkle_manifest": _merkle_sql(),
}
