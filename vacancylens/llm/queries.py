"""One query for each operator, over whole tables, and its SQL where there is one."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylens.llm import collocations, decontam, dedup, language, licenses, linededup, packing, pii, quality, quotes, sampling, search, toxicity, wavelet
from vacancylens.llm.frames import stored, table
from vacancylens.llm.tokens import TokenizerFile
from vacancylens.session import configure, new_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under the function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


@query
def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = sampling.id_remainder("doc_id", 5) == 0
    model = language.train(docs.filter(~held_out))
    labels = language.predict(docs, model)
    return labels.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query
def op2_near_dedup(spark, sf_dir):
    return dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, percent=85)


@query
def op3_license_sentences(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op4_best_fit_packing(spark, sf_dir):
    file = TokenizerFile(public_tokenizers.path("word_bpe_49k.json"), "word")
    return packing.pack_documents(table(spark, sf_dir, "documents"), file, end_id=1, capacity=4096)


@query
def op5_spaced_seeds(spark, sf_dir):
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_quote_threads(spark, sf_dir):
    return quotes.linked_conversations(table(spark, sf_dir, "conversations"))


def _replies(conversations: DataFrame) -> DataFrame:
    """Messages that quote the one before them, and the one before that a level deeper."""
    first = conversations.groupBy("conv_id", "turn").agg(F.min(F.coalesce("text", F.lit(""))).alias("quoted"))
    out = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    for back, mark in ((1, "> "), (2, "> > ")):
        before = first.select("conv_id", (F.col("turn") + back).alias("turn"), F.replace("quoted", F.lit("\n"), F.lit(f"\n{mark}")).alias("quoted"))
        quote = F.coalesce(F.concat(F.lit(mark), "quoted", F.lit("\n")), F.lit(""))
        out = out.join(before, ["conv_id", "turn"], "left").withColumn("text", F.concat(quote, "text")).drop("quoted")
    return out


@query
def quoted_replies(spark, sf_dir):
    """:func:`op6_quote_threads` over messages that do quote: the given ones hold no quotes."""
    return quotes.linked_conversations(_replies(table(spark, sf_dir, "conversations")))


@query
def op7_wavelet_shards(spark, sf_dir):
    file = TokenizerFile(public_tokenizers.path("byte_bpe_50k.json"), "byte")
    path = new_folder(spark, "shards")
    wavelet.write_shards(table(spark, sf_dir, "documents"), path, file, end_id=0)
    return wavelet.documents(wavelet.read_shards(spark, path))


@query
def op8_host_quality(spark, sf_dir):
    columns = ["doc_id", *quality.COUNTS[:5], "base_failed", "kept", "host_failed"]
    return quality.judge(table(spark, sf_dir, "documents")).select(*columns)


@query
def short_text_host(spark, sf_dir):
    """:func:`op8_host_quality` with all short texts on a host of their own, which fails as a whole."""
    docs = table(spark, sf_dir, "documents")
    host = F.when(F.char_length(F.coalesce("text", F.lit(""))) < 130, "short.example").otherwise(F.col("source"))
    columns = ["doc_id", *quality.COUNTS[:5], "base_failed", "kept", "host_failed"]
    return quality.judge(docs.withColumn("source", host)).select(*columns)


#: Stands for the deployment's secret; the surrogates depend on it.
SURROGATE_KEY = b"registered query"


@query
def op9_surrogates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace(docs, SURROGATE_KEY)


@query
def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = sampling.id_remainder("doc_id", 4) == 2
    known = docs.filter(~held_out)
    labels = table(spark, sf_dir, "labels").filter(~held_out)
    model = toxicity.train(known, labels, language.counted(known))
    scores = toxicity.score(docs.select("doc_id", "text"), model)
    return scores.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op11_line_bitmaps(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    bitmaps = stored(linededup.keep_bitmaps(docs), "bitmaps")
    kept = linededup.kept_texts(docs, bitmaps)
    return kept.withColumn("text", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).withColumnRenamed("text", "kept_sha256")


@query
def op12_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op13_mask_search(spark, sf_dir):
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES: dict[str, str] = {
    "op8_host_quality": rf"""
WITH texts AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS text, {_WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), grams AS (
  SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM texts WHERE len(w) > 8)
), repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p
        FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1)
  GROUP BY doc_id
), counts AS (
  SELECT t.doc_id, host, len(w) AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines,
    length(regexp_replace(text, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) AS n_letters
  FROM texts t LEFT JOIN repeated r ON t.doc_id = r.doc_id
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * n_symbols > 10 * word_chars
      OR 100 * n_dup_lines > 50 * n_lines OR 100 * n_letters < 50 * word_chars AS failed
  FROM counts
), hosts AS (
  SELECT host, count(*) AS n, sum(failed::BIGINT) AS failed FROM judged GROUP BY host
), total AS (
  SELECT sum(n)::DOUBLE AS n, sum(failed) / sum(n)::DOUBLE AS m, count(*) AS h FROM hosts
), spread AS (
  SELECT any_value(m) AS m, any_value(m * (1 - m)) AS noise,
    sum(hosts.n * pow(hosts.failed / hosts.n - m, 2)) / any_value(total.n)
      - any_value(m * (1 - m) * h / total.n) AS between_hosts
  FROM hosts, total
), prior AS (
  SELECT m, CASE WHEN noise = 0 OR between_hosts <= 0 THEN 1e6
    ELSE least(greatest(noise / between_hosts - 1, 1.0), 1e6) END AS strength
  FROM spread
), verdicts AS (
  SELECT host, (failed + m * strength) / (n + strength) > 0.5 AS host_failed FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT host_failed AS kept, host_failed
FROM judged JOIN verdicts ON judged.host IS NOT DISTINCT FROM verdicts.host
""",
    "op11_line_bitmaps": r"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), firsts AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (doc_id > first) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (first IS NULL OR doc_id = first), '')) AS kept_sha256
FROM keyed LEFT JOIN firsts USING (key) GROUP BY doc_id
""",
    "op12_collocations": r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, w
  FROM (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents)
  WHERE len(w) > 0
), grams AS (
  SELECT lang, w[i:i + m - 1] AS g
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, (SELECT unnest(range(1, 6)) AS m))
), f AS (
  SELECT lang, g, count(*) AS f FROM grams GROUP BY lang, g HAVING count(*) >= 100
), total AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang
), cuts AS (
  SELECT lang, g, f AS a, unnest(range(1, len(g))) AS k FROM f WHERE len(g) > 1
), scored AS (
  SELECT c.lang, c.g, a, k, l.f AS l, r.f AS r, n, ((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.g = c.g[1:k]
  JOIN f r ON r.lang = c.lang AND r.g = c.g[k + 1:] JOIN total t ON t.lang = c.lang
), worst AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), inside AS (
  SELECT DISTINCT lang, p FROM (
    SELECT lang, f, unnest([g[1:len(g) - 1], g[2:]]) AS p FROM f WHERE len(g) > 2
  ) x WHERE EXISTS (SELECT 1 FROM f WHERE f.lang = x.lang AND f.g = x.p AND 100 * x.f >= 100 * f.f)
), kept AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score
  FROM worst WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = worst.lang AND i.p = worst.g)
)
SELECT * FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept
) WHERE rank <= 2000
""",
    "op13_mask_search": r"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term
), sizes AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id
), total AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM sizes
), held AS (
  SELECT doc_id, 100 - 50 + ((50 * n * docs) // words) AS m FROM sizes, total
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, total WHERE term IN (SELECT term FROM asked) GROUP BY term, docs
), parts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * m)) AS part
  FROM tf JOIN weights USING (term) JOIN held USING (doc_id)
), scored AS (
  SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM asked JOIN parts USING (term) GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 50
""",
    "op6_quote_threads": r"""
WITH RECURSIVE messages AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
), numbered AS (
  SELECT *, regexp_matches(text, '(?m)^[ \t]*>[> \t]*') AS quotes,
    string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS lines
  FROM messages
), owned AS (
  SELECT *, CASE WHEN quotes THEN regexp_replace(regexp_replace(array_to_string(
      list_filter(lines, lambda x: NOT regexp_matches(x, '^[ \t]*>')
        AND NOT regexp_matches(x, '(?i)^.{1,200}\b(?:wrote|writes|said|schrieb|a écrit|escribió)[ \t]*:[ \t]*$')),
      chr(10)), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') ELSE text END AS own
  FROM numbered
), placed AS (
  SELECT DISTINCT conv_id, turn, text, lines, quotes, own FROM owned WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), split_lines AS (
  SELECT conv_id, turn, text, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM placed WHERE quotes
), levelled AS (
  SELECT *, length(regexp_replace(regexp_extract(line, '^[ \t]*>[> \t]*', 0), '[^>]', '', 'g')) AS level
  FROM split_lines
), turned AS (
  SELECT *, (level <> lag(level, 1, -1) OVER (PARTITION BY conv_id, turn, text ORDER BY pos))::INT AS new FROM levelled
), parted AS (
  SELECT *, sum(new) OVER (PARTITION BY conv_id, turn, text ORDER BY pos) AS part FROM turned
), passages AS (
  SELECT conv_id, turn, level, part,
    list_filter(list(trim(regexp_replace(lower(regexp_replace(line, '^[ \t]*>[> \t]*', '')), '\s+', ' ', 'g'))
      ORDER BY pos), lambda x: x <> '') AS bodies
  FROM parted WHERE level > 0 GROUP BY conv_id, turn, text, level, part
), kept AS (
  SELECT conv_id, turn, level, part, array_to_string(bodies, ' ') AS form, bodies[1] AS first_form
  FROM passages WHERE len(bodies) > 0
), units AS (
  SELECT conv_id, turn, unnest(list_distinct(list_filter(list_transform(
      list_concat([own], regexp_split_to_array(own, '\n\s*\n'),
        string_split(regexp_replace(own, '\r\n?', chr(10), 'g'), chr(10))),
      lambda x: trim(regexp_replace(lower(x), '\s+', ' ', 'g'))), lambda x: x <> ''))) AS form
  FROM placed
), originals AS (
  SELECT conv_id, form, min(turn) AS source FROM units GROUP BY conv_id, form
), tried AS (
  SELECT conv_id, turn, level, part, 1 AS rank, form FROM kept
  UNION ALL SELECT conv_id, turn, level, part, 2, first_form FROM kept
), links AS (
  SELECT conv_id, turn, level, part, arg_min(source, rank * 1000000000 + source) AS source
  FROM tried JOIN originals USING (conv_id, form) WHERE source < turn GROUP BY conv_id, turn, level, part
), parents AS (
  SELECT conv_id, turn, count(*) AS n_linked,
    first(source ORDER BY level, part, source) AS parent
  FROM links GROUP BY conv_id, turn
), chain(conv_id, turn, thread) AS (
  SELECT conv_id, turn, parent FROM parents
  UNION ALL
  SELECT c.conv_id, c.turn, p.parent FROM chain c JOIN parents p ON p.conv_id = c.conv_id AND p.turn = c.thread
), threads AS (
  SELECT conv_id, turn, min(thread) AS thread FROM chain GROUP BY conv_id, turn
), counted AS (
  SELECT conv_id, turn, count(*) AS n_passages FROM kept GROUP BY conv_id, turn
)
SELECT o.conv_id, coalesce(t.thread, o.turn) AS thread, o.turn, p.parent, o.role, o.own AS text,
  '<|' || o.role || '|>' || chr(10) || o.own || chr(10) || '<|end|>' || chr(10) AS formatted,
  coalesce(c.n_passages, 0) AS n_passages, coalesce(p.n_linked, 0) AS n_linked
FROM owned o
LEFT JOIN parents p ON p.conv_id = o.conv_id AND p.turn = o.turn
LEFT JOIN threads t ON t.conv_id = o.conv_id AND t.turn = o.turn
LEFT JOIN counted c ON c.conv_id = o.conv_id AND c.turn = o.turn
""",
}

#: The same SQL over what the two queries derive from the given tables.
ORACLES["quoted_replies"] = (
    ORACLES["op6_quote_threads"]
    .replace(
        "WITH RECURSIVE messages AS (",
        r"""
WITH RECURSIVE firsts AS (
  SELECT conv_id, turn, min(coalesce(text, '')) AS quoted FROM conversations GROUP BY conv_id, turn
), replies AS (
  SELECT c.conv_id, c.turn, role,
    coalesce('> > ' || replace(g.quoted, chr(10), chr(10) || '> > ') || chr(10), '')
      || coalesce('> ' || replace(f.quoted, chr(10), chr(10) || '> ') || chr(10), '') || coalesce(text, '') AS text
  FROM conversations c
  LEFT JOIN firsts f ON f.conv_id = c.conv_id AND f.turn = c.turn - 1
  LEFT JOIN firsts g ON g.conv_id = c.conv_id AND g.turn = c.turn - 2
), messages AS (""",
    )
    .replace("FROM conversations\n)", "FROM replies\n)")
)
ORACLES["short_text_host"] = ORACLES["op8_host_quality"].replace(
    "source AS host", "CASE WHEN length(coalesce(text, '')) < 130 THEN 'short.example' ELSE source END AS host"
)
