"""The registered queries of this subpackage and, where SQL can say it, the same results as SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyspan.llm import (
    decontaminate,
    fingerprints,
    main_text,
    merkle,
    ngram_join,
    pieces,
    rules,
    sentence_spans,
    sharding,
    spelling,
    token_counts,
    toxicity,
    warc,
)
from tallyspan.llm.common import table, written

#: Base 32 in SQL: each 5 hexadecimal digits are 4 letters.
_BASE32 = """array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hex_sha1, 5 * i + 1, 5))::INT >> s) & 31)::INT + 1, 1)), '')), '')"""

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_archives": lambda spark, sf: warc.page_archives(table(spark, sf, "pages")),
    "op2_quality_ledger": lambda spark, sf: rules.judged(table(spark, sf, "documents")),
    "op2_ablations": lambda spark, sf: rules.ablations(written(rules.ledger(table(spark, sf, "documents")), "ledger")),
    "op3_sentencepiece": lambda spark, sf: pieces.encoded_digests(table(spark, sf, "documents"), PIECE_MODEL),
    "op4_toxicity": lambda spark, sf: toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels")),
    "op5_minimax_shards": lambda spark, sf: sharding.shard_by_bytes(table(spark, sf, "documents")),
    "op6_decontamination": lambda spark, sf: decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark")),
    "op7_main_text": lambda spark, sf: main_text.extracted(table(spark, sf, "pages")),
    "op8_token_counts": lambda spark, sf: token_counts.counts_after_revision(table(spark, sf, "documents"), RANKS, public_tokenizers.PATTERN),
    "op9_sentence_spans": lambda spark, sf: sentence_spans.deduped(table(spark, sf, "documents")),
    "op9_passages": lambda spark, sf: sentence_spans.deduped(table(spark, sf, "documents"), passages=True),
    "op10_ngram_join": lambda spark, sf: ngram_join.similar(table(spark, sf, "documents")),
    "op11_spelling_variants": lambda spark, sf: spelling.variants(table(spark, sf, "documents")),
    "op12_merkle_manifest": lambda spark, sf: merkle.verified(table(spark, sf, "documents")),
    "op13_fingerprints": lambda spark, sf: fingerprints.fingerprinted(table(spark, sf, "documents")),
}


def _crc32(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of an expression in SQL, bit by bit."""
    byte = f"('0x' || substr(hex(encode({text})), (k // 8) * 2 + 1, 2))::BIGINT"
    step = f"CASE WHEN k % 8 = 0 THEN xor(c, {byte}) ELSE c END"
    bits = f"list_concat([4294967295::BIGINT], range(0, 8 * octet_length(encode({text}))))"
    return f"xor(list_reduce({bits}, lambda c, k: xor(({step}) >> 1, 3988292384 * (({step}) & 1))), 4294967295)"


_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _lower(text: str) -> str:
    return f"translate({text}, '{_LETTERS.upper()}', '{_LETTERS}')"


def _one_byte(word: str) -> str:
    """A word with one byte for each code point, as the distance in SQL counts bytes."""
    return f"translate({word}, '{''.join(map(chr, range(0xC0, 0x100)))}', '{''.join(chr(c) for c in range(33, 98) if chr(c) != chr(39))}')"


def _field(name: str) -> str:
    return f"coalesce(octet_length(encode({name}::VARCHAR)) || ':' || {name}::VARCHAR, '-')"


def _levels(name: str, leaves: str) -> str:
    """All levels of the trees over the leaves of each grp, in SQL."""
    return f"""{name} AS (
            SELECT grp, pos, 0 AS level, digest, count(*) OVER (PARTITION BY grp) AS n FROM {leaves}
            UNION ALL
            SELECT grp, pos // {merkle.FAN}, level + 1, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + {merkle.FAN - 1}) // {merkle.FAN}
            FROM {name} WHERE n > 1 GROUP BY grp, pos // {merkle.FAN}, level)"""


def _sides(rows: str, key: str, grp: str, levels: str, first: str) -> str:
    """What flanks each row's node on every level, as text around a bar."""
    mine = f"o.pos // ({merkle.FAN} ** level)::BIGINT"
    return f"""SELECT o.{key}, {first} + level AS step, coalesce(string_agg(digest, '' ORDER BY x.pos) FILTER (x.pos < {mine}), '') || '|'
                         || coalesce(string_agg(digest, '' ORDER BY x.pos) FILTER (x.pos > {mine}), '') AS side
                  FROM {rows} o JOIN {levels} x ON x.n > 1 AND x.grp IS NOT DISTINCT FROM {grp} AND x.pos // {merkle.FAN} = {mine} // {merkle.FAN} GROUP BY ALL"""


#: Near copies among the rows of {docs}: every pair of different n-gram sets that share an n-gram, compared.
GROUPS = f"""
    WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, * FROM {{docs}}),
    w AS (SELECT rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM d),
    sets AS (SELECT rid, doc_id, CASE WHEN len(words) = 0 THEN NULL WHEN len(words) < {ngram_join.N} THEN [array_to_string(words, ' ')]
             ELSE list_sort(list_distinct(list_transform(range(1, len(words) - {ngram_join.N - 2}), lambda i: array_to_string(words[i:i + {ngram_join.N - 1}], ' ')))) END AS grams
             FROM w),
    classes AS (SELECT grams, min(rid) AS node, min(doc_id) AS c_doc, count(*) AS n_docs, len(any_value(grams)) AS n FROM sets WHERE grams IS NOT NULL GROUP BY grams),
    g AS (SELECT node, n, unnest(grams) AS gram FROM classes),
    links AS (SELECT a.node AS a, b.node AS b FROM g a JOIN g b ON a.gram = b.gram AND a.node <> b.node
              GROUP BY a.node, b.node, a.n, b.n HAVING count(*) >= {ngram_join.THRESHOLD} * (a.n + b.n - count(*)) - 1e-9),
    reach AS (SELECT node AS a, node AS b FROM classes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    named AS (SELECT a AS node, min(c_doc) AS class_doc FROM reach JOIN classes ON reach.b = classes.node GROUP BY a),
    counts AS (SELECT a AS node, sum(n_docs) AS linked, count(*) AS texts FROM links JOIN classes ON links.b = classes.node GROUP BY a),
    grouped AS (SELECT d.*, CASE WHEN grams IS NULL THEN d.doc_id ELSE class_doc END AS class_id,
                       coalesce(linked, 0)::BIGINT + coalesce(n_docs - 1, 0)::BIGINT AS n_links, coalesce(texts, 0)::BIGINT AS n_text_links
                FROM d JOIN sets USING (rid) LEFT JOIN classes USING (grams) LEFT JOIN named USING (node) LEFT JOIN counts USING (node))
    """

#: Sentence spans of {docs}: left_over has what stays of each row.
SPANS = f"""
    WITH d AS (SELECT row_number() OVER () AS rid, * FROM {{docs}}),
    k AS (SELECT rid, md5(coalesce(text, ''))[:15] AS text_key FROM d),
    p AS (SELECT rid, doc_id, unnest(parts) AS part, unnest(range(len(parts))) AS i
          FROM (SELECT rid, doc_id, regexp_extract_all(text, '{sentence_spans.PATTERN}') AS parts FROM d)),
    w AS (SELECT *, regexp_extract_all(part, '[^\\x20\\x09-\\x0D]+') AS words FROM p),
    c AS (SELECT *, sum(len(words)) OVER (PARTITION BY rid ORDER BY i) AS upto FROM w),
    e AS (SELECT a.rid, a.doc_id, a.i AS start, min(b.i) AS stop
          FROM c a JOIN c b ON a.rid = b.rid AND b.i > a.i AND b.upto - a.upto + len(a.words) >= {sentence_spans.WORDS}
          GROUP BY ALL),
    s AS (SELECT e.rid, e.doc_id, e.start, e.stop, array_to_string(flatten(list(w.words ORDER BY w.i)), ' ') AS span
          FROM e JOIN w ON w.rid = e.rid AND w.i BETWEEN e.start AND e.stop GROUP BY ALL),
    f AS (SELECT *, first_value(ROW(doc_id, text_key, start)) OVER (PARTITION BY span ORDER BY doc_id NULLS FIRST, text_key, start) AS first FROM s JOIN k USING (rid)),
    gone AS (SELECT DISTINCT rid, unnest(range(start, stop + 1)) AS i FROM f WHERE ROW(doc_id, text_key, start) IS DISTINCT FROM first),
    n AS (SELECT rid, count(*) AS n_sentences, count(gone.i) AS n_removed,
                 string_agg(part, '' ORDER BY w.i) FILTER (gone.i IS NULL) AS stays
          FROM w LEFT JOIN gone USING (rid, i) GROUP BY rid),
    left_over AS (SELECT d.* EXCLUDE (text), coalesce(n_sentences, 0)::BIGINT AS n_sentences, coalesce(n_removed, 0)::BIGINT AS n_removed,
                         CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(stays, '') END AS text
                  FROM d LEFT JOIN n USING (rid))
    """

#: The ledger, as f.
LEDGER = f"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
        w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words FROM d),
        g AS (SELECT rid, i, list_slice(words, i, i + 7) AS gram
              FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
        r AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1),
        rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM r, range(8) AS s(k) GROUP BY rid),
        l AS (SELECT rid, line FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
              WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
        dup AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM l GROUP BY rid),
        m AS (SELECT doc_id, len(words) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
                     length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
                     coalesce(n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
                     len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS n_echo_words
              FROM w LEFT JOIN rep USING (rid) LEFT JOIN dup USING (rid)),
        f AS (SELECT *, {" | ".join(f"(CASE WHEN {r.fails} THEN {1 << i} ELSE 0 END)" for i, r in enumerate(rules.RULES))} AS failed FROM m)"""

_CASES = ", ".join(f"('{p}', '{r}', {rules.mask(names)}, {rules.mask((r,))})" for p, names in rules.POLICIES.items() for r in names)

SQL: dict[str, str] = {
    "op1_warc_archives": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
        r AS (SELECT *, sha1(payload) AS hex_sha1, min(page_id) OVER (PARTITION BY payload) AS first_id FROM p)
        SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
               CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
        FROM r""",
    "op2_quality_ledger": LEDGER
    + f"""
        SELECT doc_id, {", ".join(f"{m}::BIGINT AS {m}" for m in rules.MEASURES)}, failed::BIGINT AS failed,
               (failed & {rules.mask(rules.POLICIES["base"])}) <> 0 AS base_failed,
               (failed & {rules.mask(rules.POLICIES["v2"])}) = 0 AS kept
        FROM f""",
    "op2_ablations": LEDGER
    + f""",
        grid(policy, rule, all_bits, bit) AS (VALUES {_CASES})
        SELECT policy, rule, count(*) AS n_docs, count(*) FILTER ((failed & all_bits) = 0) AS n_kept,
               count(*) FILTER ((failed & bit) <> 0) AS n_failed_rule, count(*) FILTER ((failed & (all_bits - bit)) = 0) AS n_kept_without
        FROM f, grid GROUP BY policy, rule""",
    "op9_sentence_spans": SPANS.format(docs="documents")
    + "SELECT doc_id, n_sentences, n_removed, text FROM left_over",
    "op10_ngram_join": GROUPS.format(docs="documents") + "SELECT doc_id, class_id, n_links, n_text_links FROM grouped",
    "op11_spelling_variants": f"""
        WITH RECURSIVE r AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
        d AS (SELECT doc_id, {_lower("run")} AS word, count(*) AS n FROM r WHERE length(run) >= {spelling.LEAST_LENGTH} GROUP BY ALL),
        h AS (SELECT *, coalesce(doc_id::VARCHAR, '') || ':' || word AS named FROM d),
        c AS (SELECT *, {_crc32("named")} AS h FROM h),
        t AS (SELECT CASE WHEN h % {spelling.TYPO_EVERY} = 0 THEN substr(word, 1, h % length(word)) || substr(word, h % length(word) + 2) ELSE word END AS word, n FROM c),
        v AS (SELECT word, sum(n)::BIGINT AS n FROM t WHERE length(word) >= {spelling.LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {spelling.LEAST_COUNT}),
        b AS (SELECT word, n, length(word) AS l, {_one_byte("word")} AS x FROM v),
        p AS (SELECT a.word AS a, a.n AS a_n, b.word AS b, b.n AS b_n FROM b a JOIN b ON b.l = a.l AND a.word < b.word WHERE levenshtein(a.x, b.x) = 1
              UNION ALL SELECT a.word, a.n, b.word, b.n FROM b a JOIN b ON b.l = a.l + 1 WHERE levenshtein(a.x, b.x) = 1),
        both_ways AS (SELECT a AS word, b AS near, b_n AS near_n FROM p UNION ALL SELECT b, a, a_n FROM p),
        best AS (SELECT word, count(*) AS n_near, max(near_n) AS top, first(near ORDER BY near_n DESC, encode(near)) AS near FROM both_ways GROUP BY word),
        f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= {spelling.RATIO} * v.n THEN near END AS form,
                     CASE WHEN top >= {spelling.RATIO} * v.n THEN top END AS form_n FROM v LEFT JOIN best USING (word)),
        chain AS (SELECT word, word AS last, 0 AS steps FROM f UNION ALL SELECT c.word, f.form, steps + 1 FROM chain c JOIN f ON f.word = c.last WHERE f.form IS NOT NULL),
        ends AS (SELECT word, arg_max(last, steps) AS root FROM chain GROUP BY word)
        SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM f JOIN ends USING (word)""",
    "op12_merkle_manifest": f"""
        WITH RECURSIVE d AS (SELECT *, doc_id::VARCHAR AS dec, CASE WHEN {_crc32("coalesce(doc_id::VARCHAR, '')")} % 3 = 0 AND doc_id IS NOT NULL
                             THEN {_lower("text")} ELSE text END AS later FROM documents),
        l AS (SELECT doc_id, lang, sha256({" || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS leaf,
                     sha256({" || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "later"))}) AS found FROM d),
        o AS (SELECT *, row_number() OVER () AS rid, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l),
        leaves AS (SELECT lang AS grp, pos, leaf AS digest FROM o),
        {_levels("t", "leaves")},
        subs AS (SELECT grp AS lang, digest, row_number() OVER (ORDER BY encode(grp) NULLS FIRST) - 1 AS pos FROM t WHERE n = 1),
        tops AS (SELECT 0 AS grp, pos, digest FROM subs),
        {_levels("u", "tops")},
        steps AS ({_sides("o", "rid", "o.lang", "t", "0")} UNION ALL
                  {_sides("(SELECT o.rid, subs.pos FROM o JOIN subs ON o.lang IS NOT DISTINCT FROM subs.lang)", "rid", "0", "u", "1000")}),
        paths AS (SELECT rid, list(side ORDER BY step) AS path FROM steps GROUP BY rid)
        SELECT o.doc_id, o.leaf, subs.digest AS subroot, u.digest AS root, sha256(replace(array_to_string(coalesce(path, []), ''), '|', '')) AS proof_sha256,
               list_reduce(list_concat([o.found], coalesce(path, [])), lambda node, s: sha256(split_part(s, '|', 1) || node || split_part(s, '|', 2))) AS folded_root,
               folded_root = u.digest AS verified
        FROM o JOIN subs ON o.lang IS NOT DISTINCT FROM subs.lang JOIN u ON u.n = 1 LEFT JOIN paths USING (rid)""",
}
