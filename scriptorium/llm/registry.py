"""The queries opN_ of the dealt operators, each over its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import bpe, chat, exact_dedup, language_id, merkle, mixing, near_dedup, nearest, prefix_trie, private_data, secret_scan, warc
from .common import table


def op1_language_id(spark, sf_dir):
    """doc_id, held_out, lang_pred, score, entropy, rejected of every document; learns from texts and labels outside of the held-out fifth. Null ids count as no fold (learned from)."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    models = language_id.train(docs.filter(~held_out), "lang", "text")
    found = language_id.identify(docs, models)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "entropy", "rejected")


def op2_nearest_neighbours(spark, sf_dir):
    """query_id, rank, vec_id, score: the 20 nearest of each twentieth vector, over all vectors; unusable ones take no part."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.nearest_neighbours(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op3_near_dedup(spark, sf_dir):
    """doc_id, n_shingles, component_id, kept of every document, by two-word shingles at 0.8; nulls as in near_duplicates."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op4_private_data(spark, sf_dir):
    """doc_id, the counts of each kind, n_private (their sum), base_sha256, spans, n_terms and sanitised_sha256 of every document; null texts are empty."""
    return private_data.span_digests(private_data.find_spans(table(spark, sf_dir, "documents"), sanitised="digest"))


def op5_chat_format(spark, sf_dir):
    """conv_id and digests of every conversation as read back from its formatted text; null texts and roles are empty, a null conv_id is one conversation."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.chat_digests(chat.read_back(chat.format_trees(chat.linear_replies(rows.unionByName(hard)))))


def op6_warc(spark, sf_dir):
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page as read back from the archives; a null html is empty."""
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op7_exact_dedup(spark, sf_dir):
    """doc_id, keep_id, group_size, kept, text_sha256 of every document; a null text is empty, an id wins over none."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), digest=True).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_mix_sources(spark, sf_dir):
    """doc_id, size, source_size, target, taken of every document; null texts have size 0, a null source is one of its own."""
    mix = mixing.mix_sources(table(spark, sf_dir, "documents"), F.array("source"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op9_token_counts(spark, sf_dir):
    """doc_id, n_bytes, n_tokens, over_limit of every document; a null text is empty."""
    return bpe.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_bpe_codec(spark, sf_dir):
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document; a null text is empty."""
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_secret_scan(spark, sf_dir):
    """doc_id, n_assign, n_access, n_hex, n_checked, base_sha256, spans of every document; a null text is empty."""
    return secret_scan.secret_digests(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


def op12_merkle_manifest(spark, sf_dir):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every document; one in seven by the id's crc32 is folded with n_chars + 1 (a null id isn't)."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    told = F.when(tampered, F.col("n_chars").cast("decimal(38,0)") + 1).otherwise(F.col("n_chars").cast("decimal(38,0)"))
    shown = merkle.framed([F.col("doc_id"), F.col("source"), F.col("lang"), told, F.col("text")])
    _, found = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", keep={"shown": shown})
    return merkle.verified(found, "shown")


def op13_prefix_trie(spark, sf_dir):
    """A row for each prefix of the rebuilt conversations, as prefix_trie gives them."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), span=100, most=6)


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_nearest_neighbours, op3_near_dedup, op4_private_data, op5_chat_format, op6_warc, op7_exact_dedup, op8_mix_sources, op9_token_counts, op10_bpe_codec,
        op11_secret_scan, op12_merkle_manifest, op13_prefix_trie,
    )
}

#: CRC-32 by its table: tab holds what each byte gives.
CRC_TABLE = """tab AS MATERIALIZED (SELECT list(v ORDER BY i) AS tab FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS t(i)))"""


def _crc(text: str) -> str:
    return f"xor(4294967295, list_reduce([4294967295] || list_transform(string_split({text}, ''), lambda ch: unicode(ch)::BIGINT), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])))"


def _matches(kind: str, number: int, pattern: str, group: int) -> str:
    return f"SELECT doc_id, row_id, {number} AS number, '{kind}' AS kind, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {group}) AS v, regexp_split_to_array(t, '{pattern}') AS gaps FROM d"


def _framed(n_chars: str) -> str:
    values = ("doc_id", "source", "lang", n_chars, "text")
    return "sha256(" + " || ".join(f"coalesce(strlen(({v})::VARCHAR) || ':' || ({v})::VARCHAR, '-')" for v in values) + ")"


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)

_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
#: What precedes an age key's own digits in its checksum: the prefix's high bits, 0, and its low bits.
_AGE = [ord(x) >> 5 for x in "age-secret-key-"] + [0] + [ord(x) & 31 for x in "age-secret-key-"]
_BECH32 = " ".join(f"xor(CASE WHEN (c >> {25 + i}) & 1 = 1 THEN {g} ELSE 0 END," for i, g in enumerate((0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3))) + " xor((c & 33554431) << 5, x))))))"

ORACLES = {
    # all pairs that share a shingle are counted: for small tables
    "op3_near_dedup": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN w ELSE [w[i] || ' ' || w[i + 1] for i in range(1, len(w))] END) AS shingle FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        sized AS (SELECT s.doc_id, hash(shingle) AS shingle, n FROM s JOIN n USING (doc_id)),
        links AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b FROM sized x JOIN sized y ON x.shingle = y.shingle AND x.doc_id != y.doc_id AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
          GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
        reach AS (SELECT a AS node, b AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
        c AS (SELECT node, min(other) AS least FROM reach GROUP BY node)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(c.least, d.doc_id), d.doc_id) AS component_id, coalesce(least(c.least, d.doc_id), d.doc_id) = d.doc_id AS kept
        FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.node = d.doc_id""",
    # base32 of the 160 bits: eight groups of five hexadecimal digits give four characters each
    "op6_warc": r"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        h AS (SELECT page_id, strlen(html) AS payload_bytes, html, sha1(html) AS hex FROM p),
        b AS (SELECT *, [substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
          ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT + 1, 1) for i in range(32)] AS letters FROM h),
        m AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM b)
        SELECT page_id, payload_bytes, array_to_string(letters, '') AS payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
          CASE WHEN page_id != last THEN last END AS refers_to
        FROM m""",
    "op7_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)""",
    # the template's own characters are 15 a user's turn, 9 an assistant's, 23 and the role's any other; an escaped character is two
    "op5_chat_format": r"""
        WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
          coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
          sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
          sum(length(text) + length(regexp_replace(text, '[^<\[\\]', '', 'g')) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 ELSE 23 + length(role) + length(regexp_replace(role, '[^<\[\\]', '', 'g')) END)::BIGINT AS formatted_chars
        FROM r GROUP BY conv_id""",
    "op11_secret_scan": rf"""
        WITH {CRC_TABLE}, d AS (SELECT doc_id, row_number() OVER () AS row_id, coalesce(text, '') AS t FROM documents),
        found AS ({_matches("assign", 0, "(" + _NAMES + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2)}
          UNION ALL {_matches("access", 1, "AKIA[A-Z0-9]+", 0)} UNION ALL {_matches("hex", 2, "[0-9a-f]+", 0)}
          UNION ALL {_matches("github", 3, r"\bgh[pousr]_([0-9A-Za-z]{36})\b", 1)} UNION ALL {_matches("npm", 4, r"\bnpm_([0-9A-Za-z]{36})\b", 1)}
          UNION ALL {_matches("age", 5, r"\bAGE-SECRET-KEY-1([02-9AC-HJ-NP-Z]{58})\b", 1)}),
        each AS (SELECT doc_id, row_id, number, kind, unnest(m) AS m, unnest(v) AS v, unnest(gaps[:len(m)]) AS gap, generate_subscripts(m, 1) AS i FROM found),
        placed AS (SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY row_id, number ORDER BY i) AS stop FROM each),
        checked AS (SELECT *, CASE number WHEN 0 THEN length(v) >= 6 WHEN 1 THEN length(m) >= 20 WHEN 2 THEN length(m) >= 24
          WHEN 5 THEN list_reduce([1] || {_AGE} || list_transform(string_split(v, ''), lambda ch: strpos('QPZRY9X8GF2TVDW0S3JN54KHCE6MUA7L', ch) - 1), lambda c, x: {_BECH32}) = 1
          ELSE substr(v, 31) = array_to_string(list_transform([5, 4, 3, 2, 1, 0], lambda k: substr('{_BASE62}', ({_crc("substr(v, 1, 30)")} // pow(62, k)::BIGINT % 62)::BIGINT + 1, 1)), '') END AS ok FROM placed, tab),
        s AS (SELECT row_id, number, kind, kind || ':' || (stop - length(m))::BIGINT || ':' || stop::BIGINT AS span, stop - length(m) AS start FROM checked WHERE ok)
        SELECT d.doc_id, count(*) FILTER (number = 0) AS n_assign, count(*) FILTER (number = 1) AS n_access, count(*) FILTER (number = 2) AS n_hex, count(*) FILTER (number > 2) AS n_checked,
          sha256(coalesce(string_agg(span, ',' ORDER BY start, number) FILTER (number <= 2), '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY start, number), '') AS spans
        FROM d LEFT JOIN s USING (row_id) GROUP BY d.row_id, d.doc_id""",
    # up(node): the level above, until a tree has one node; then the same over the subroots
    "op12_merkle_manifest": rf"""
        WITH RECURSIVE {CRC_TABLE},
        f AS (SELECT *, coalesce({_crc("doc_id::VARCHAR")} % 7 = 0, false) AS tampered FROM documents, tab),
        d AS (SELECT doc_id, lang, {_framed("n_chars")} AS leaf, CASE WHEN tampered THEN {_framed("n_chars + 1")} ELSE {_framed("n_chars")} END AS shown FROM f),
        o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
        up AS (SELECT lang, 0 AS level, i, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM o
          UNION ALL SELECT lang, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), max(n + 1) // 2 FROM up WHERE n > 1 GROUP BY lang, level, i // 2),
        sub AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS j FROM (SELECT lang, h AS subroot, level AS height FROM up WHERE n = 1)),
        top AS (SELECT 0 AS level, j AS i, subroot AS h, count(*) OVER () AS n FROM sub UNION ALL SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), max(n + 1) // 2 FROM top WHERE n > 1 GROUP BY level, i // 2),
        steps AS (SELECT lang, level, i, n, h FROM up),
        -- each row climbs from its leaf, then from its subroot
        climb AS (SELECT o.lang, o.i AS at, sub.j, sub.height, 0 AS step, o.shown AS h, '' AS proof, o.i AS place FROM o JOIN sub ON o.lang IS NOT DISTINCT FROM sub.lang
          UNION ALL SELECT c.lang, c.at, c.j, c.height, c.step + 1,
            CASE WHEN x.step IS NULL THEN sha256(c.h) WHEN p % 2 = 1 THEN sha256(x.h || c.h) ELSE sha256(c.h || x.h) END, c.proof || coalesce(x.h, ''), p // 2
          FROM (SELECT *, CASE WHEN step = height THEN j ELSE place END AS p FROM climb WHERE step < height + (SELECT max(level) FROM top)) c
          LEFT JOIN (SELECT lang, level AS step, i, h, false AS above FROM up UNION ALL SELECT NULL, level, i, h, true FROM top) x
            ON x.above = (c.step >= c.height) AND (x.above OR x.lang IS NOT DISTINCT FROM c.lang) AND x.step = CASE WHEN c.step >= c.height THEN c.step - c.height ELSE c.step END AND x.i = xor(p, 1))
        SELECT o.doc_id, o.leaf, sub.subroot, top.h AS root, sha256(c.proof) AS proof_sha256, c.h AS folded_root, c.h = top.h AS verified
        FROM o JOIN sub ON o.lang IS NOT DISTINCT FROM sub.lang JOIN climb c ON c.j = sub.j AND c.at = o.i AND c.step = sub.height + (SELECT max(level) FROM top) JOIN top ON top.n = 1""",
    # a node is known by its depth and its smallest member
    "op13_prefix_trie": rf"""
        WITH {CRC_TABLE},
        t AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        h AS (SELECT conv_id, turns, ({_crc("conv_id::VARCHAR")} % 6)::BIGINT AS h FROM t, tab),
        r AS (SELECT h.conv_id, coalesce(b.turns[:h], []) || h.turns[h + 1:] AS turns FROM h LEFT JOIN t b ON b.conv_id = h.conv_id - h.conv_id % 100),
        p AS (SELECT conv_id, len(turns) AS long, unnest(range(len(turns) + 1)) AS d, turns FROM r),
        m AS MATERIALIZED (SELECT conv_id, long, d, CASE WHEN d = 0 THEN 0 ELSE length(turns[d].text) END AS size, min(conv_id) OVER (PARTITION BY d, turns[:d]) AS id FROM p),
        n AS MATERIALIZED (SELECT id, d, count(*) AS n, max(size) AS size, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = long), '')) AS ends FROM m GROUP BY id, d),
        u AS MATERIALIZED (SELECT n.*, m.id AS parent FROM n LEFT JOIN m ON m.conv_id = n.id AND m.d = n.d - 1),
        k AS (SELECT parent AS id, d - 1 AS d, count(*) AS kids FROM u WHERE d > 0 GROUP BY ALL),
        w AS (SELECT u.*, coalesce(kids, 0) AS kids FROM u LEFT JOIN k USING (id, d)),
        s AS (SELECT m.id, m.d, count(*) FILTER (kids = 0) AS n_leaves, sum((n - 1) * w.size)::BIGINT AS saved FROM w JOIN m ON m.conv_id = w.id AND m.d <= w.d GROUP BY m.id, m.d)
        SELECT id AS conv_id, d AS depth, parent AS parent_conv_id, n AS n_convs, kids AS n_children, n_leaves, saved AS saved_tokens, ends AS ends_sha256 FROM w JOIN s USING (id, d)""",
}
