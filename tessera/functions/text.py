"""Text features as Column expressions over whole texts.

Everything is a built-in string / regex / higher-order array function, so
it runs inside whole-stage code generation on the executors; documents are
never truncated.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The NLTK English stop-word list (179 words) ...
NLTK_ENGLISH_STOPWORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've", "you'll",
    "you'd", "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "she's",
    "her", "hers", "herself", "it", "it's", "its", "itself", "they", "them", "their", "theirs",
    "themselves", "what", "which", "who", "whom", "this", "that", "that'll", "these", "those", "am",
    "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does",
    "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as", "until", "while",
    "of", "at", "by", "for", "with", "about", "against", "between", "into", "through", "during",
    "before", "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only",
    "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don", "don't",
    "should", "should've", "now", "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren", "aren't",
    "couldn", "couldn't", "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't",
    "haven", "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn", "mustn't", "needn",
    "needn't", "shan", "shan't", "shouldn", "shouldn't", "wasn", "wasn't", "weren", "weren't", "won",
    "won't", "wouldn", "wouldn't",
]
# ... and the extra tokens the tweet cleaner adds to it.
EXTRA_STOPWORDS = ["1", "2", "it'll", "ill", "=", "+", "'s'", '"']
CLEANER_STOPWORDS = NLTK_ENGLISH_STOPWORDS + EXTRA_STOPWORDS

# Small polarity lexicon (word, polarity, subjectivity) used in
# place of the TextBlob lexicon, which is not available here.
LEXICON = [
    ("good", 0.7, 0.6), ("great", 0.8, 0.75), ("excellent", 1.0, 1.0), ("happy", 0.8, 1.0),
    ("love", 0.5, 0.6), ("best", 1.0, 0.3), ("nice", 0.6, 1.0), ("safe", 0.5, 0.5),
    ("bad", -0.7, 0.67), ("terrible", -1.0, 1.0), ("awful", -1.0, 1.0), ("poor", -0.4, 0.6),
    ("sad", -0.5, 1.0), ("worst", -1.0, 1.0), ("hate", -0.8, 0.9), ("wrong", -0.5, 0.9),
    ("fire", -0.1, 0.2), ("dead", -0.2, 0.4), ("new", 0.14, 0.45), ("free", 0.4, 0.8),
]

WORD_TOKEN = r"[\p{L}\p{N}_]{2,}"        # 2+ word characters, as the tf-idf token pattern


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


#: What ``str.split()`` takes for white space.
WHITE = r"[\t-\r\x1c-\x1f\x85\p{Z}]"


def words(col) -> Column:
    """Whitespace tokens (``str.split()``): empty text gives []."""
    return F.filter(F.split(_c(col), WHITE + "+"), lambda w: w != "")


# ---------------------------------------------------------------- F1
def clean_text(col, stopwords: list[str] = CLEANER_STOPWORDS) -> Column:
    """Tweet cleaner (F1): lower; drop apostrophes, @mentions, #tags and
    URLs; brackets / punctuation / non-alphanumerics to spaces; split; drop
    stop words; re-join with single spaces.  Null gives ''."""
    t = F.lower(F.coalesce(_c(col), F.lit("")))
    # apostrophes first: dropping them can join two tokens
    t = F.regexp_replace(t, "'", "")
    # URLs after mentions and tags, whose removal can cut a URL short
    t = F.regexp_replace(t, r"@[A-Za-z0-9_]+|#[A-Za-z0-9_]+", "")
    t = F.regexp_replace(t, r"http\S+", "")
    # (), !, ? and [...] blocks and every other non-alphanumeric become
    # separators; runs of spaces vanish in the split below, so one pass
    # equals the three sequential replacements
    t = F.regexp_replace(t, r"\[.*?\]|[^a-z0-9]", " ")
    # isin over a literal list plans as a hash-set lookup (InSet), unlike a
    # linear array_contains scan per word
    kept = F.filter(words(t), lambda w: ~w.isin(list(stopwords)))
    return F.array_join(kept, " ")


# ---------------------------------------------------------------- F2-F10
def count_chars(col) -> Column:
    """F2."""
    return F.length(_c(col))


def count_words(col) -> Column:
    """F3."""
    return F.size(words(col))


def count_capital_chars(col) -> Column:
    """upper-case letters."""
    return F.length(F.regexp_replace(_c(col), r"[^\p{Lu}]", ""))


def count_capital_words(col) -> Column:
    """words with a cased letter and no lower-case letter (``isupper``)."""
    return F.size(F.filter(words(col), lambda w: (w == F.upper(w)) & (w != F.lower(w))))


SENTENCE = r"[^.!?\s][^.!?]*(?:[.!?]+|$)"


def count_sentences(col) -> Column:
    """F6 (approximation of Punkt): runs of text ended by . ! ? or the end."""
    return F.size(F.regexp_extract_all(_c(col), F.lit(SENTENCE), 0))


def count_unique_words(col) -> Column:
    """F7."""
    return F.size(F.array_distinct(words(col)))


def count_stopwords(col, stopwords: list[str] = NLTK_ENGLISH_STOPWORDS) -> Column:
    """F8: word tokens (letters/digits/_ runs, case kept) that are stop words."""
    toks = F.regexp_extract_all(_c(col), F.lit(r"[\p{L}\p{N}_]+"), 0)
    return F.size(F.filter(toks, lambda w: w.isin(list(stopwords))))


def count_hashtags(col, pattern: str = r"#[A-Za-z0-9_]+") -> Column:
    """F9; pass ``r'#w[A-Za-z0-9]*'`` for the reference's literal-w pattern."""
    return F.size(F.regexp_extract_all(_c(col), F.lit(pattern), 0))


def ratio(num: Column, den: Column) -> Column:
    """Guarded division for F10 ratios (null on 0)."""
    return F.try_divide(num.cast("double"), den)


def text_stats(col) -> dict[str, Column]:
    """All F2-F10 counts and ratios for one text column."""
    c = {
        "char_count": count_chars(col), "word_count": count_words(col),
        "capital_chars": count_capital_chars(col), "capital_words": count_capital_words(col),
        "sent_count": count_sentences(col), "unique_words": count_unique_words(col),
        "stopword_count": count_stopwords(col), "hashtag_count": count_hashtags(col),
    }
    c["avg_wordlength"] = ratio(c["char_count"], c["word_count"])
    c["avg_sentlength"] = ratio(c["word_count"], c["sent_count"])
    c["unique_vs_words"] = ratio(c["unique_words"], c["word_count"])
    c["stopwords_vs_words"] = ratio(c["stopword_count"], c["word_count"])
    return c


# ---------------------------------------------------------------- F11-F13
def tokens_to_rows(df: DataFrame, id_col: str, text: str, keep=()) -> DataFrame:
    """``unnest_tokens`` (F11): one row per (id, position, lower-cased word)."""
    return df.select(id_col, *keep, F.posexplode(words(F.lower(F.col(text)))).alias("pos", "word"))


def term_frequency(df: DataFrame, by: list[str], text: str) -> DataFrame:
    """Word counts per class (F12): partial aggregation on (class, word)."""
    toks = df.select(*by, F.explode(words(F.lower(F.col(text)))).alias("word"))
    return toks.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("count"))


def tfidf(df: DataFrame, id_col: str, text: str, max_features: int = 150) -> DataFrame:
    """TF-IDF over the ``max_features`` most frequent terms (F13), smooth idf
    ln((1+n)/(1+df))+1, L2-normalised per document, as a long table
    (id, term, weight).  Vocabulary ties go to the alphabetically first term.

    Tokens are maximal runs of letters / digits / '_' of length >= 2 (the
    default scikit-learn token pattern), from one split of the lower-cased
    text.  Plan: one (doc, term) count, term statistics on it, a top-k
    vocabulary (bounded by ``max_features``, broadcast), and the norm as a
    window over each document's <= ``max_features`` vocabulary rows."""
    toks = F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}_]+"), lambda w: F.length(w) >= 2)
    tf = df.select(id_col, F.explode(toks).alias("term")).groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))
    stats = tf.groupBy("term").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))
    vocab = stats.orderBy(F.desc("total"), F.asc("term")).limit(max_features)
    n_docs = df.select(F.count(F.lit(1))).scalar()
    v = vocab.select("term", (F.ln((1 + n_docs) / (1 + F.col("df"))) + 1).alias("idf"))
    w = tf.join(F.broadcast(v), "term").withColumn("raw", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "term", (F.col("raw") / norm).alias("weight"))


# ---------------------------------------------------------------- F14
def lexicon_sentiment(df: DataFrame, id_col: str, text: str, lexicon=LEXICON) -> DataFrame:
    """Lexicon polarity / subjectivity (F14, re-aimed TextBlob): mean score of
    the words found in a small broadcast lexicon, 0 when none; label by sign."""
    spark = df.sparkSession
    lex = spark.createDataFrame(lexicon, "word string, polarity double, subjectivity double")
    toks = df.select(id_col, F.explode(words(F.lower(F.col(text)))).alias("word"))
    s = toks.join(F.broadcast(lex), "word").groupBy(id_col).agg(
        F.avg("polarity").alias("polarity"), F.avg("subjectivity").alias("subjectivity"))
    out = df.select(id_col).join(s, id_col, "left").na.fill(0.0, ["polarity", "subjectivity"])
    label = F.when(F.col("polarity") < 0, "negative").when(F.col("polarity") == 0, "neutral").otherwise("positive")
    return out.withColumn("label", label)


# ---------------------------------------------------------------- F15-F18
def equals_flag(col, value: str) -> Column:
    """Lower-cased equality flag."""
    return (F.lower(_c(col)) == value.lower()).cast("int")


def replace_chars(col, src: str, dst: str) -> Column:
    """Character replacement (F16), e.g. ' ' -> '_'."""
    return F.translate(_c(col), src, dst)


def first_difference(a, b) -> Column:
    """0-based index of the first differing character of two strings (F18);
    0 when equal; when one is a prefix of the other, the shorter length."""
    ca, cb = F.split(_c(a), ""), F.split(_c(b), "")
    same = F.zip_with(ca, cb, lambda x, y: F.coalesce(x == y, F.lit(False)))
    p = F.array_position(same, False)
    return F.when(p == 0, F.lit(0)).otherwise(p - 1)
