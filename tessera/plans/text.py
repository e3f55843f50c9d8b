"""Text queries over ``documents`` and ``conversations``."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from .registry import register

_STOP_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in T.CLEANER_STOPWORDS) + "]"
_NLTK_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in T.NLTK_ENGLISH_STOPWORDS) + "]"
# str.split(): runs of any Unicode white space separate words, at the ends too
_WORDS = ("list_filter(string_split_regex({x}, '[\\t-\\r\\x1c-\\x1f\\x{{85}}\\p{{Z}}]+'), lambda s: s <> '')")


def _words(x: str) -> str:
    return _WORDS.format(x=x)


_CLEAN = """regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  regexp_replace(lower(coalesce(text, '')), '''', '', 'g'), '@[A-Za-z0-9_]+', '', 'g'), '#[A-Za-z0-9_]+', '', 'g'),
  'http\\S+', '', 'g'), '[()!?]', ' ', 'g'), '\\[.*?\\]', ' ', 'g'), '[^a-z0-9]', ' ', 'g')"""


@register("f01_clean_text", "F1 F42 U10", "doc_id:i clean:s", sql=f"""
SELECT doc_id, array_to_string(list_filter({_words('c')}, lambda w: NOT list_contains({_STOP_SQL}, w)), ' ') AS clean
FROM (SELECT doc_id, {_CLEAN} AS c FROM documents)""")
def f01_clean_text(t):
    return t.documents.select("doc_id", T.clean_text("text").alias("clean"))


@register("f02_text_counts", "F2 F3 F4 F5 F6 F7 F8 F9 F10",
          "doc_id:i char_count:i word_count:i capital_chars:i capital_words:i sent_count:i unique_words:i "
          "stopword_count:i hashtag_count:i avg_wordlength:f avg_sentlength:f unique_vs_words:f "
          "stopwords_vs_words:f", sql=f"""
WITH c AS (
 SELECT doc_id, length(text) AS char_count, len({_words('text')}) AS word_count,
   length(regexp_replace(text, '[^\\p{{Lu}}]', '', 'g')) AS capital_chars,
   len(list_filter({_words('text')}, lambda w: w = upper(w) AND w <> lower(w))) AS capital_words,
   len(regexp_extract_all(text, '{T.SENTENCE}')) AS sent_count,
   len(list_distinct({_words('text')})) AS unique_words,
   len(list_filter(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+'), lambda w: list_contains({_NLTK_SQL}, w)))
     AS stopword_count,
   len(regexp_extract_all(text, '#[A-Za-z0-9_]+')) AS hashtag_count
 FROM documents)
SELECT *, char_count / nullif(word_count, 0) AS avg_wordlength, word_count / nullif(sent_count, 0) AS avg_sentlength,
  unique_words / nullif(word_count, 0) AS unique_vs_words, stopword_count / nullif(word_count, 0) AS stopwords_vs_words
FROM c""")
def f02_text_counts(t):
    return t.documents.select("doc_id", *[e.alias(k) for k, e in T.text_stats("text").items()])


@register("f11_term_frequency", "F11 F12", "lang:s word:s count:i", sql=f"""
SELECT lang, word, count(*) AS count FROM (SELECT lang, unnest({_words('lower(text)')}) AS word FROM documents)
GROUP BY ALL""")
def f11_term_frequency(t):
    return T.term_frequency(t.documents, ["lang"], "text")


@register("f11_token_rows", "F11", "doc_id:i n_tokens:i max_pos:i", sql=f"""
SELECT doc_id, count(*) AS n_tokens, max(pos) AS max_pos FROM (
  SELECT doc_id, generate_subscripts(w, 1) - 1 AS pos FROM (SELECT doc_id, {_words('lower(text)')} AS w FROM documents))
GROUP BY doc_id""")
def f11_token_rows(t):
    r = T.tokens_to_rows(t.documents, "doc_id", "text")
    return r.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_tokens"), F.max("pos").alias("max_pos"))


@register("f13_tfidf", "F13", "doc_id:i term:s weight:f", sql=f"""
WITH tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{T.WORD_TOKEN}')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL),
st AS (SELECT term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY term),
v AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1 AS idf
      FROM st ORDER BY total DESC, term LIMIT 150),
w AS (SELECT doc_id, term, tf * idf AS raw FROM tf JOIN v USING (term))
SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM w""")
def f13_tfidf(t):
    return T.tfidf(t.documents, "doc_id", "text", 150)


def _lex_sql() -> str:
    rows = " UNION ALL ".join(f"SELECT '{w}' AS word, {p} AS polarity, {s} AS subjectivity" for w, p, s in T.LEXICON)
    return f"""
WITH lex AS ({rows}),
tok AS (SELECT doc_id, unnest({_words('lower(text)')}) AS word FROM documents),
s AS (SELECT doc_id, avg(polarity) AS polarity, avg(subjectivity) AS subjectivity FROM tok JOIN lex USING (word)
      GROUP BY doc_id)
SELECT d.doc_id, coalesce(polarity, 0) AS polarity, coalesce(subjectivity, 0) AS subjectivity,
  CASE WHEN coalesce(polarity, 0) < 0 THEN 'negative' WHEN coalesce(polarity, 0) = 0 THEN 'neutral'
       ELSE 'positive' END AS label
FROM documents d LEFT JOIN s USING (doc_id)"""


@register("f14_lexicon_sentiment", "F14", "doc_id:i polarity:f subjectivity:f label:s", sql=_lex_sql())
def f14_lexicon_sentiment(t):
    return T.lexicon_sentiment(t.documents, "doc_id", "text")


@register("f15_flags_and_keys", "F15 F16 F17 P7 P8 P10 P11", "doc_id:i is_src1:i key:s lang_group:s", sql="""
SELECT doc_id, CAST(lower(source) = 'src1' AS INTEGER) AS is_src1,
  replace('d ' || CAST(doc_id AS VARCHAR) || ' ' || lang || ' ' || source, ' ', '_') AS key,
  CASE WHEN lang IN ('en', 'fr') THEN lang ELSE 'Other' END AS lang_group
FROM documents""")
def f15_flags_and_keys(t):
    from ..functions import columns as P
    d = t.documents
    key = F.concat_ws(" ", F.lit("d"), F.col("doc_id").cast("string"), "lang", "source")
    return d.select("doc_id", T.equals_flag("source", "src1").alias("is_src1"),
                    T.replace_chars(key, " ", "_").alias("key"),
                    P.rare_to_other("lang", ["en", "fr"]).alias("lang_group"))


@register("f18_first_difference", "F18", "conv_id:i turn:i first_diff:i", sql="""
WITH p AS (SELECT conv_id, turn, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM conversations)
SELECT conv_id, turn,
  CASE WHEN list_position(list_transform(list_zip(string_split(text, ''), string_split(prev, '')),
                          lambda z: coalesce(z[1] = z[2], false)), false) IS NULL THEN 0
       ELSE list_position(list_transform(list_zip(string_split(text, ''), string_split(prev, '')),
                          lambda z: coalesce(z[1] = z[2], false)), false) - 1 END AS first_diff
FROM p WHERE prev IS NOT NULL""")
def f18_first_difference(t):
    w = Window.partitionBy("conv_id").orderBy("turn")
    p = t.conversations.withColumn("prev", F.lag("text").over(w)).where(F.col("prev").isNotNull())
    return p.select("conv_id", "turn", T.first_difference("text", "prev").alias("first_diff"))
