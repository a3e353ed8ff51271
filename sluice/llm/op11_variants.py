"""Spelling variant grouping by PartEnum signatures, in DataFrame functions.

The letters of a word are a multiset, that is a binary vector over (letter,
how many-eth). One inserted, deleted or replaced code point changes at most
two of its bits, so words at edit distance one lie within Hamming distance 2.
The letters are dealt into ``PARTS`` parts by their code; a signature keeps
the letters of all parts but two, one signature per choice of the two: vectors
within distance 2 agree in at least one of the C(PARTS, 2) signatures.

Syllables make many words with the same letters, so a signature is joined
with what the same edit must leave alone: the longer word's length and either
the front half of the longer word or its back half. Candidates of that
equi-join are verified with the edit distance itself. Nothing is lost by the
key: an edit in the back half leaves the front half equal, and the reverse.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm._sql import CRC_TABLE_SQL, crc_sql
from sluice.llm._stage import staged

PARTS = 4
DISTANCE = 2  # Hamming distance of the letter vectors
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
DROP_EVERY = 199

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RUN = "[A-Za-zÀ-ÿ]+"
# Every code point that a lower-cased run can hold.
LETTERS = [chr(c) for c in (*range(0x61, 0x7B), *range(0xC0, 0x100))]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): runs of letters after the keyed deletion, over all texts.

    Partial counts are taken before the shuffle, so a very frequent word costs
    one row per map task.
    """
    runs = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate(F.col(f"`{text_col}`"), _UPPER, _UPPER.lower()), F.lit(RUN),
                                       F.lit(0))).alias("run")).filter(F.length("run") >= min_length)
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = (h % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + F.lit(2), F.length("run")))
    return (runs.select(F.when(h % F.lit(DROP_EVERY) == 0, shorter).otherwise(F.col("run")).alias("word"))
            .filter(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count))


def _signatures(letters: Column) -> list[Column]:
    """The sorted letters without those of two parts, for every choice of the two."""
    out = []
    for pair in combinations(range(PARTS), DISTANCE):
        gone = "".join(c for c in LETTERS if ord(c) % PARTS in pair)
        out.append(F.translate(letters, gone, ""))
    return out


def signature_keys(words: DataFrame) -> DataFrame:
    """(key, own, word, n): ``own`` marks keys under the word's own length; the
    others are under the next length, where longer words look for it."""
    def halves(longer: Column, own: bool) -> Column:
        half = F.floor(longer / 2).cast("int")
        back = longer - half  # that many at the end of either word
        keys = []
        for i, s in enumerate(_signatures(F.col("letters"))):
            for kind, part in (("f", F.substring("word", F.lit(1), half)),
                               ("b", F.substring("word", F.length("word") - back + F.lit(1), back))):
                keys.append(F.struct(F.xxhash64(F.lit(i), F.lit(kind), longer, part, s).alias("key"),
                                     F.lit(own).alias("own")))
        return F.array(*keys)

    both = F.concat(halves(F.length("word"), True), halves(F.length("word") + F.lit(1), False))
    return (words.withColumn("letters", F.array_join(F.array_sort(F.split("word", "")), ""))
            .select("word", "n", F.explode(both).alias("k")).select("k.key", "k.own", "word", "n"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n), both ways, for all pairs at edit distance one."""
    keys = staged(signature_keys(words), "signature_keys")
    a = keys.filter("own").select("key", "word", "n")
    b = keys.select("key", "own", F.col("word").alias("near"), F.col("n").alias("near_n"))
    # Equal lengths meet under their own length (once, by order); a shorter word
    # meets the longer one under that word's length.
    once = ~F.col("own") | (F.col("word") < F.col("near"))
    found = (a.join(b, "key").filter(once & (F.levenshtein("word", "near", 1) == 1))
             .select("word", "n", "near", "near_n").distinct())
    found = staged(found, "near_pairs")
    return found.unionByName(found.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                          F.col("word").alias("near"), F.col("n").alias("near_n")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form; the counts grow along a chain, so
    chains end, and every round halves what is left of them."""
    known = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = staged(known.join(step, "root", "left")
                       .select("word", F.coalesce("next", "root").alias("root"),
                               F.col("next").isNotNull().alias("moved")), "roots")
        known = moved.select("word", "root")
        if not moved.filter("moved").limit(1).count():
            return known


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """One row per word: word, n, form, root, n_near, form_n.

    Words, nearness, form and root are as the module says: a word's form is its
    near word of largest n (ties: smallest in code-point order) if that is at
    least ``ratio`` times the word's own n; the root is the end of the chain
    of forms, the word itself if it has none. Null and empty texts hold no
    words; a null id is written as empty text before the colon of the keyed
    deletion; rows that repeat an id or a text count each. Other columns are
    ignored; an empty table gives an empty result.
    """
    words = staged(word_counts(docs, id_col, text_col, min_length, min_count), "word_counts")
    near = near_pairs(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w"))).alias("best"))
    is_form = -F.col("best.m") >= F.lit(ratio) * F.col("n")
    formed = staged(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.w")).alias("form"), F.when(is_form, -F.col("best.m")).alias("form_n")), "forms")
    roots = _roots(formed.filter("form is not null"))
    return (formed.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


ORACLE = f"""
WITH RECURSIVE {CRC_TABLE_SQL.strip()},
runs AS (SELECT doc_id, run, count(*) AS m FROM (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, '{_UPPER}', '{_UPPER.lower()}'), '{RUN}')) AS run FROM documents)
  WHERE length(run) >= {MIN_LENGTH} GROUP BY ALL),
hashed AS (SELECT run, m, {crc_sql("(doc_id || ':' || run)")} AS h FROM runs, tab),
counted AS (SELECT CASE WHEN h % {DROP_EVERY} = 0
    THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, m FROM hashed),
words AS (SELECT word, sum(m)::BIGINT AS n FROM counted WHERE length(word) >= {MIN_LENGTH}
  GROUP BY word HAVING sum(m) >= {MIN_COUNT}),
cut AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS left_over
  FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b
    ON a.i = b.i AND a.left_over = b.left_over AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.left_over = w.word
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.left_over = w.word),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS top FROM pairs GROUP BY word),
form AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= {RATIO} * n THEN
    (SELECT min(near) FROM pairs p WHERE p.word = w.word AND p.near_n = top) END AS form,
    CASE WHEN top >= {RATIO} * n THEN top END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
chain AS (SELECT word, word AS root, form AS next FROM form
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN form f ON f.word = c.next)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM form f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""
