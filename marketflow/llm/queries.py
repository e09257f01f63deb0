"""The registered query of each operator, over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.llm import chat, chunks, forest, guesses, maxent, merkle, mixing, packing, simhash, spectra, tokens, toxicity, urls, wavelet
from marketflow.llm.common import prepare, remainder, table
from marketflow.session import scratch


def op1_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learns from labels whose crc32 remainder by 5 is not 0."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    held_out = (remainder(F.col("doc_id"), 5) == 0).alias("held_out")
    return toxicity.score(docs, model).select("doc_id", held_out, "score", "predicted")


def op2_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document; learns from those whose crc32 remainder by 10 is not 0."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (remainder(F.col("doc_id"), 10) == 0).alias("held_out"))
    model, counts = maxent.train(docs.where("NOT held_out"))
    return maxent.scored(docs, model, counts)


def op3_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, read back from wavelet matrices."""
    prepare(spark)
    path = scratch(spark, "wavelet")
    wavelet.write_shards(table(spark, sf_dir, "documents"), path, tokens.default_path())
    return wavelet.read_shards(spark, path)


def op4_temperature_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document once per pass of the mixture that has it."""
    prepare(spark)
    mixed = mixing.mixture(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "n_tokens", F.round("weight", 9).alias("weight"), "block", "pass", "place")


def op5_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one made of control strings, read back from its examples."""
    prepare(spark)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.examples(turns.unionByName(chat.probe(spark))))


def op6_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth vector, over all vectors."""
    prepare(spark)
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return forest.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op7_host_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict of every page's url."""
    prepare(spark)
    return urls.judged(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op8_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of 2048 ids."""
    prepare(spark)
    return packing.packed(table(spark, sf_dir, "documents"), tokens.default_path())


def op9_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all documents."""
    prepare(spark)
    return chunks.groups(table(spark, sf_dir, "documents"))


def op10_ball_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_groups(docs).select("doc_id", "fingerprint", "component_id")


def op11_guess_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: fixed forms, and credential values that are hard to guess."""
    prepare(spark)
    found = guesses.secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", guesses.joined(F.col("spans")).alias("spans"))


def op12_rank_one_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector along the first 16 eigenvectors of the covariance, scaled to unit variance."""
    prepare(spark)
    return spectra.whitened(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op13_octopus_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and checked proof of every document; ids whose crc32 is divisible by 7 are tampered with."""
    prepare(spark)
    return merkle.proofs(table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 7) == 0)


QUERIES = {f.__name__: f for f in (
    op1_compression_toxicity, op2_maxent_scores, op3_wavelet_shards, op4_temperature_mixture, op5_prefix_targets, op6_prefix_forest, op7_host_words,
    op8_cost_packing, op9_chunk_recipes, op10_ball_simhash, op11_guess_cost, op12_rank_one_whitening, op13_octopus_manifest)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op9_chunk_recipes": f"""
        WITH t AS (SELECT doc_id, {_LOWER} AS s FROM documents),
             g AS (SELECT s, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY s)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(s) AS text_sha256 FROM t JOIN g USING (s)""",
    "op5_prefix_targets": """
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, turn, role, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS p(turn, role)),
        n AS (
            SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS turns,
                   sum(length('<|im_start|>' || role || chr(10) || '<|im_end|>' || chr(10)) + length(text)
                       + length(text) - length(replace(text, '\', '')) + (length(text) - length(replace(text, '<|', ''))) // 2) OVER w AS chars
            FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(chars) FILTER (role = 'assistant' OR pos = turns)::BIGINT AS formatted_chars
        FROM n GROUP BY conv_id""",
    "op4_temperature_mixture": r"""
        WITH RECURSIVE rows_ AS (
            SELECT doc_id, source, coalesce('=' || source, '') AS s, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens,
                   ('0x' || substr(md5('7:' || doc_id), 1, 8))::BIGINT % 512 AS block FROM documents),
        cells AS (SELECT s, block, sum(n_tokens)::BIGINT AS tokens FROM rows_ GROUP BY ALL),
        totals AS (SELECT s, sum(tokens)::BIGINT AS tokens FROM cells GROUP BY s),
        most AS (SELECT max(tokens)::DOUBLE AS most, count(*) FILTER (tokens > 0) AS sources FROM totals),
        shares AS (SELECT s, tokens, tokens / most AS share FROM totals, most),
        even(i, low, high) AS (
            SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
            UNION ALL
            SELECT i + 1, CASE WHEN ok THEN middle ELSE low END, CASE WHEN ok THEN high ELSE middle END
            FROM (SELECT i, low, high, (low + high) / 2 AS middle,
                         (SELECT ln(sum(pow(share, (low + high) / 2))) - (low + high) / 2 * sum(pow(share, (low + high) / 2) * ln(share)) / sum(pow(share, (low + high) / 2))
                          FROM shares WHERE tokens > 0) >= 0.9 * ln((SELECT sources FROM most)) AS ok FROM even WHERE i < 24)),
        within(i, low, high) AS (
            SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
            UNION ALL
            SELECT i + 1, CASE WHEN ok THEN low ELSE middle END, CASE WHEN ok THEN middle ELSE high END
            FROM (SELECT i, low, high, (low + high) / 2 AS middle,
                         (SELECT max(pow(share, (low + high) / 2 - 1)) FROM shares WHERE tokens > 0) <= 2.0 AS ok FROM within WHERE i < 24)),
        alpha AS (SELECT greatest((SELECT low FROM even WHERE i = 24), (SELECT high FROM within WHERE i = 24)) AS a),
        powers AS (SELECT s, tokens, CASE WHEN tokens > 0 THEN pow(share, a) ELSE 0 END AS p FROM shares, alpha),
        turns AS (SELECT s, tokens, p / (SELECT sum(p) FROM powers) AS weight, CASE WHEN tokens > 0 THEN round(p * most / tokens, 9) ELSE 1 END AS t FROM powers, most),
        plan AS (SELECT s, weight, floor(t)::BIGINT AS full_, floor((t - floor(t)) * tokens)::BIGINT AS rest FROM turns),
        line AS MATERIALIZED (
            SELECT s, block, tokens, weight, full_, rest, row_number() OVER (PARTITION BY s ORDER BY md5('7:' || (full_ + 1) || ':' || s || ':' || block), block) AS pos
            FROM cells JOIN plan USING (s)),
        part(s, pos, used, fits) AS (
            SELECT s, 0::BIGINT, 0::BIGINT, false FROM plan
            UNION ALL
            SELECT l.s, l.pos, CASE WHEN used + tokens <= rest THEN used + tokens ELSE used END, used + tokens <= rest FROM part AS p JOIN line AS l ON l.s = p.s AND l.pos = p.pos + 1),
        taken AS (SELECT s, block, weight, full_ + fits::BIGINT AS copies FROM line JOIN part USING (s, pos))
        SELECT doc_id, source, n_tokens, round(weight, 9) AS weight, block, pass, substr(md5('7:' || pass || ':' || s || ':' || block), 1, 8) AS place
        FROM rows_ JOIN (SELECT s, block, weight, unnest(range(1, copies + 1)) AS pass FROM taken) USING (s, block)""",
    "op13_octopus_manifest": """
        WITH RECURSIVE h AS (
            SELECT doc_id, lang, n_chars, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') AS head, coalesce(strlen(text) || ':' || text, '-') AS tail,
                   xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
                       lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda d, z: CASE WHEN d % 2 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END)),
                       4294967295) % 7 = 0 AS tampered FROM documents),
        leaves AS (
            SELECT doc_id, lang, sha256(head || coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
                   CASE WHEN tampered THEN sha256(head || coalesce(length((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) END AS changed FROM h),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS leaves,
                   dense_rank() OVER (ORDER BY coalesce('=' || lang, '')) AS tree FROM leaves),
        low(tree, level, idx, digest, n) AS (
            SELECT tree, 0, place, leaf, leaves FROM placed
            UNION ALL
            SELECT tree, level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (max(n) + 1) // 2 FROM low WHERE n > 1 GROUP BY tree, level, idx // 2),
        subroots AS (SELECT tree, digest FROM low WHERE n = 1),
        high(level, idx, digest, n) AS (
            SELECT 0, tree - 1, digest, (SELECT count(*) FROM subroots) FROM subroots
            UNION ALL
            SELECT level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (max(n) + 1) // 2 FROM high WHERE n > 1 GROUP BY level, idx // 2),
        nodes AS (
            SELECT tree, level, idx, digest, n FROM low WHERE n > 1
            UNION ALL SELECT s.tree, level + x.top, idx, h.digest, n FROM high AS h, (SELECT tree, max(level) AS top FROM low GROUP BY tree) AS x JOIN subroots AS s USING (tree) WHERE n > 1),
        heights AS (SELECT tree, max(level) AS top FROM low GROUP BY tree),
        steps AS (
            SELECT d.doc_id, d.tree, d.place, d.leaf, k.level, CASE WHEN k.level < t.top THEN d.place >> k.level ELSE (d.tree - 1) >> (k.level - t.top) END AS at
            FROM placed AS d JOIN heights AS t USING (tree), (SELECT unnest(range(0, 64)) AS level) AS k
            WHERE k.level < t.top + (SELECT max(level) FROM high)),
        siblings AS (
            SELECT s.tree, s.place, s.level, s.at, n.digest FROM steps AS s LEFT JOIN nodes AS n ON n.tree = s.tree AND n.level = s.level AND n.idx = xor(s.at, 1)),
        folded(tree, place, level, digest) AS (
            SELECT tree, place, 0, coalesce(changed, leaf) FROM placed
            UNION ALL
            SELECT f.tree, f.place, f.level + 1, sha256(CASE WHEN s.digest IS NULL THEN f.digest WHEN s.at % 2 = 1 THEN s.digest || f.digest ELSE f.digest || s.digest END)
            FROM folded AS f JOIN siblings AS s ON s.tree = f.tree AND s.place = f.place AND s.level = f.level),
        proofs AS (SELECT tree, place, sha256(coalesce(string_agg(digest, '' ORDER BY level), '')) AS proof_sha256 FROM siblings GROUP BY tree, place),
        ends AS (SELECT tree, place, arg_max(digest, level) AS folded_root FROM folded GROUP BY tree, place)
        SELECT doc_id, leaf, s.digest AS subroot, r.digest AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = r.digest AS verified
        FROM placed JOIN subroots AS s USING (tree) JOIN ends USING (tree, place) LEFT JOIN proofs USING (tree, place), (SELECT digest FROM high WHERE n = 1) AS r""",
}
