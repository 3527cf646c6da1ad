"""Line de-duplication: an exact set-similarity join of lines, of which the later one of each similar pair goes.

Words of a line are ordered by rarity; two lines of Jaccard t share a word among the first n - ceil(t n) + 1 of each, which
are indexed. Length and position bounds leave few pairs, and those are verified on the words. Below five words only equal
sets are similar, and of four words also those with one more: such lines meet by their whole set. DataFrame operations only.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pressmill.llm.common import written
from pressmill.session import remove_table

#: lines are similar if PERCENT * union <= 100 * intersection of their distinct words
PERCENT = 80
#: lines of fewer words are neither removed nor compared: only blank ones are not, unless the caller names another limit
LEAST_WORDS = 1
#: lines of fewer distinct words are similar to sets of at most one word more, and then hold all words or are held whole
SET_WORDS = 5
#: the bit that tells the key of a whole set from that of a word
SET_KEY = -1 << 63
#: buckets of the word counts that order words by rarity; fixed, whatever the corpus, as each plan with them spells them out
COUNT_BUCKETS = 1 << 18
#: turns in which lines meet, and in which pairs of lines are verified
TURNS = 4
#: bits of a word's hash in its number, below the step of rarity
HASH_BITS = 57
#: of so many of its rarest words a line is first held against the earliest line
STAR_KEYS = 6
#: half the width of a band of word counts, as a logarithm: a little more than similar lines differ at most
BAND = math.log(1.01 * 100 / PERCENT)
#: words from which on lines are told apart by 128 bits
LONG = 32
#: white space that separates words of a line, and of a text, beside the blank
LINE_SPACE, TEXT_SPACE = "\t\x0b\f\r", "\t\n\x0b\f\r"
#: a line of so many words and one more; only its first words are looked at
LONG_ENOUGH = r"^[ \t\x0B\f\r]*+(?:[^ \t\x0B\f\r]++[ \t\x0B\f\r]++){%d}[^ \t\x0B\f\r]"


def _bucket(h: Column) -> Column:
    return F.pmod(h, F.lit(COUNT_BUCKETS)).cast("int")


def split_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, pos, line) of the lines of texts with an id."""
    return docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.posexplode(F.split(text_col, "\n", -1)).alias("pos", "line"))


def _one_space(text: Column, spaces: str) -> Column:
    # a split at one plain character needs no regular expression
    for c in spaces:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def _words(text: Column, spaces: str = LINE_SPACE) -> Column:
    return F.array_remove(F.split(_one_space(text, spaces), " "), "")


def word_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """How often words of each bucket occur in all texts (COUNT_BUCKETS numbers, a bounded result)."""
    words = docs.select(F.explode(_words(F.col(text_col), TEXT_SPACE)).alias("w"))
    rows = written(words.select(_bucket(F.xxhash64("w")).alias("b")).groupBy("b").count()).toArrow()
    counts = np.zeros(COUNT_BUCKETS, np.int64)
    counts[rows["b"].to_numpy()] = rows["count"].to_numpy()
    return counts


def _steps(counts: np.ndarray) -> Column:
    """The step of rarity of each bucket, 0 to 63, as a printable byte: a binary constant is read at a place without being copied."""
    return F.lit(bytearray((33 + np.minimum(63, np.round(1.5 * np.log2(counts + 1)))).astype(np.uint8).tobytes()))


def _numbers(line: Column, steps: Column) -> Column:
    """The distinct words of a line, rarest first, as numbers: a step of rarity in the high bits, the word's hash below."""
    hashes = F.array_distinct(F.transform(F.split(_one_space(line, LINE_SPACE), " "), lambda w: F.xxhash64(w)))
    words = F.array_remove(hashes, F.xxhash64(F.lit("")))
    step = lambda h: F.ascii(F.substring(steps, _bucket(h) + 1, F.lit(1)).cast("string")) - 33
    return F.sort_array(F.transform(words, lambda h: F.shiftleft(step(h).cast("long"), HASH_BITS).bitwiseOR(
        h.bitwiseAND(F.lit((1 << HASH_BITS) - 1)))))


def _prefix() -> Column:
    """Of the words ``numbers`` those that are indexed."""
    n = F.size("numbers")
    return F.when(n < SET_WORDS, F.array().cast("array<long>")).otherwise(
        F.slice("numbers", 1, (n - F.ceil(n * (PERCENT / 100) - 1e-9) + 1).cast("int")))


def _sets() -> Column:
    """The keys of the whole set of few words; of SET_WORDS words those of the sets without one, as a line of these is similar."""
    def whole(words):
        return F.xxhash64(words).bitwiseOR(F.lit(SET_KEY))

    n, words = F.size("numbers"), F.col("numbers")
    return (F.when(n < SET_WORDS, F.array(whole(words)))
            .when(n == SET_WORDS, F.transform(words, lambda w: whole(F.filter(words, lambda o: o != w))))
            .otherwise(F.array().cast("array<long>")))


def _parities() -> list[Column]:
    """``parity``: a bit of 64 for each word, flipped by each word that has it; ``part``: the same of about half of the words.

    Each word that one of two lines has and the other lacks flips one bit, so parities differ in as many bits at most. Of long
    lines ``part`` and the rest of ``parity`` are told apart, as 128 bits.
    """
    def flipped(words):
        return F.aggregate(words, F.lit(0).cast("long"), lambda all_, h: all_.bitwiseXOR(
            F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))))

    half = F.filter("numbers", lambda h: h.bitwiseAND(F.lit(64)) == 0)
    return [flipped("numbers").alias("parity"), F.when(F.size("numbers") >= LONG, flipped(half)).otherwise(F.lit(0).cast("long")).alias("part")]


def _near_parity(a: str, b: str) -> Column:
    """Whether the words that one of the lines ``a`` and ``b`` (prefixes of column names) lacks of the other can be few enough."""
    def col(name):
        return F.col(a + name).bitwiseXOR(F.col(b + name))

    both = F.bit_count(col("part")) + F.bit_count(col("parity").bitwiseXOR(col("part")))
    edits = F.when(F.least(a + "n", b + "n") >= LONG, both).otherwise(F.bit_count(col("parity")))
    return edits * (100 + PERCENT) <= (100 - PERCENT) * (F.col(a + "n") + F.col(b + "n"))


def _before(a_id: str, a_pos: str, b_id: str, b_pos: str) -> Column:
    return (F.col(a_id) < F.col(b_id)) | ((F.col(a_id) == F.col(b_id)) & (F.col(a_pos) < F.col(b_pos)))


def _possible(n_a: str, i_a: str, n_b: str, i_b: str) -> Column:
    """Length and position bounds for two lines that share the words at places i_a and i_b as their first."""
    rest = 1 + F.least(F.col(n_a) - 1 - F.col(i_a), F.col(n_b) - 1 - F.col(i_b))
    return _near_length(n_a, n_b) & (rest * (100 + PERCENT) >= PERCENT * (F.col(n_a) + F.col(n_b)))


def _never_beyond(n_a: str, i_a: str, n_b: str, i_b: str) -> Column:
    """The bounds for two lines that share the words at places i_a and i_b and, before them, as many as there can be."""
    most = 1 + F.least(i_a, i_b) + F.least(F.col(n_a) - 1 - F.col(i_a), F.col(n_b) - 1 - F.col(i_b))
    return _near_length(n_a, n_b) & (most * (100 + PERCENT) >= PERCENT * (F.col(n_a) + F.col(n_b)))


def _near_length(n_a: str, n_b: str) -> Column:
    return 100 * F.least(n_a, n_b) >= PERCENT * F.greatest(n_a, n_b)


def _marks(rows: DataFrame) -> DataFrame:
    """``rows`` with ``marks``: a bit of 64 for each of its ``keys``, and ``lost``: how many keys have found theirs taken."""
    def bit(key):
        return F.call_function("shiftleft", F.lit(1).cast("long"), key.bitwiseAND(F.lit(63)).cast("int"))

    marks = F.aggregate("keys", F.lit(0).cast("long"), lambda all_, k: all_.bitwiseOR(bit(k["key"])))
    # a one-row explode keeps an expression from being copied to each place that names it
    return rows.select("*", F.explode(F.array(marks)).alias("marks")).withColumn("lost", F.size("keys") - F.bit_count("marks"))


def _most_shared(marks_a: str, lost_a: str, marks_b: str, lost_b: str) -> Column:
    """How many keys two lines share at most: of shared keys, no more are without a bit of their own than either line has lost."""
    return F.bit_count(F.col(marks_a).bitwiseAND(F.col(marks_b))) + F.least(lost_a, lost_b)


def _similar(pairs: DataFrame, split: DataFrame) -> DataFrame:
    """(id, pos) of the later lines of ``pairs`` (id, pos, o_id, o_pos) that are similar to the earlier ones.

    A line's words go with each of its pairs, so the pairs are held against each other in turns, a share of the later
    lines each, with the earlier lines that they name.
    """
    def turn_of(*line):
        return F.pmod(F.xxhash64(*line), F.lit(TURNS)).cast("int")

    def has(bit):
        return F.col("turns").bitwiseAND(F.lit(1 << bit)) != 0

    # a bit for each turn in which a line is an earlier one, and one if it is a later one
    named = (pairs.select("id", "pos", F.lit(1 << TURNS).alias("turns"))
             .union(pairs.select("o_id", "o_pos", F.call_function("shiftleft", F.lit(1), turn_of("id", "pos"))))
             .groupBy("id", "pos").agg(F.bit_or("turns").alias("turns")))
    lines = written(split.join(named, ["id", "pos"]).select("id", "pos", "turns", F.array_distinct(_words(F.col("line"))).alias("a")))
    shared = F.size(F.array_intersect("a", "b"))
    found = None
    for turn in range(TURNS):
        mine = turn_of("id", "pos") == turn
        late = lines.where(mine & has(TURNS)).select("id", "pos", "a")
        early = lines.where(has(turn)).select(F.col("id").alias("o_id"), F.col("pos").alias("o_pos"), F.col("a").alias("b"))
        both = pairs.where(mine).join(late, ["id", "pos"]).join(early, ["o_id", "o_pos"])
        part = written(both.where(100 * shared >= PERCENT * (F.size("a") + F.size("b") - shared)).select("id", "pos").distinct())
        found = part if found is None else found.union(part)
    remove_table(lines)
    return found


def _index(rows: DataFrame, keys: str | Column) -> DataFrame:
    """A row per key: id, pos, n, parity, part, i, key."""
    return rows.select("id", "pos", "n", "parity", "part", F.posexplode(keys).alias("i", "key"))


def _star(firsts: DataFrame) -> DataFrame:
    """(id, pos, o_id, o_pos): lines with the earliest line under their rarest words, and under their sets."""
    entries = _index(firsts, F.concat(F.slice("keys", 1, STAR_KEYS), "sets")).withColumn("i", F.when(F.col("key") < 0, -1).otherwise(F.col("i")))
    so_far = Window.partitionBy("key").orderBy("id", "pos").rowsBetween(Window.unboundedPreceding, 0)
    entry = F.struct("id", "pos", "n", "i", "parity", "part")
    # two lines of SET_WORDS words that share all but one are not similar
    first = F.when((F.col("key") < 0) & (F.col("n") == SET_WORDS), F.first(F.when(F.col("n") < SET_WORDS, entry), ignorenulls=True).over(so_far)
                   ).otherwise(F.first(entry).over(so_far))
    met = entries.withColumn("o", first).where((F.col("id") != F.col("o.id")) | (F.col("pos") != F.col("o.pos")))
    met = met.select(*entries.columns, *(F.col(f"o.{c}").alias(f"o_{c}") for c in ("id", "pos", "n", "i", "parity", "part")))
    return written(met.where(_possible("n", "i", "o_n", "o_i") & _near_parity("", "o_")).select("id", "pos", "o_id", "o_pos").distinct())


def _met(left: DataFrame, firsts: DataFrame) -> DataFrame:
    """(id, pos, o_id, o_pos): lines of ``left`` with all earlier ones that can be similar, by the rarest word they share.

    Words are taken in turns, a share of them each. Only lines of like length meet: those of one band of word counts and of
    the neighbouring band that is nearer, which reaches as far as similar lines can differ.
    """
    place = F.log(F.col("n").cast("double")) / (2 * BAND)
    band = F.floor(place).cast("int")
    bands = F.array(band, F.when(place - band < 0.5, band - 1).otherwise(band + 1))
    found = None
    for turn in range(TURNS):
        mine = F.pmod("key", F.lit(TURNS)) == turn
        late = _index(left, "keys").where(mine).select("*", F.explode(bands).alias("band"))
        early = _index(firsts, "keys").where(mine).select("key", band.alias("band"), *(
            F.col(c).alias(f"o_{c}") for c in ("id", "pos", "n", "i", "parity", "part")))
        part = written(late.join(early, ["key", "band"]).where(
            _before("o_id", "o_pos", "id", "pos") & _possible("n", "i", "o_n", "o_i") & _near_parity("", "o_"))
            .select("id", "pos", "o_id", "o_pos").distinct())
        found = part if found is None else found.union(part)
    return found.distinct()


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """(id, pos) of every line that is similar to an earlier one, of the same or a smaller id.

    Equal lines are one for the join, so a very common line costs one row per map task. Lines are first held against the
    earliest ones that share one of their rarest words; only lines that this leaves are held against all earlier ones. Lines
    that meet by a whole set need that first step only: the earliest line that can be similar to them is.
    """
    split = split_lines(docs, id_col, text_col)
    steps = _steps(word_counts(docs.where(F.col(text_col).isNotNull()), text_col))
    compared = split.where(F.col("line").rlike(LONG_ENOUGH % (least_words - 1)))
    classes = compared.select("id", "pos", F.xxhash64("line").alias("h"), F.crc32("line").alias("c"))
    lead = classes.groupBy("h", "c").agg(F.min(F.struct("id", "pos")).alias("f"))
    copies = written(classes.join(lead, ["h", "c"]).where((F.col("id") != F.col("f.id")) | (F.col("pos") != F.col("f.pos"))).select("id", "pos"))
    # a one-row explode keeps an expression from being copied to each place that names it
    numbered = compared.select("id", "pos", F.explode(F.array(_numbers(F.col("line"), steps))).alias("numbers"))
    firsts = written(numbered.select("id", "pos", F.size("numbers").alias("n"), *_parities(), _prefix().alias("keys"), _sets().alias("sets"))
                     .join(copies, ["id", "pos"], "left_anti"))
    gone = _similar(_star(firsts), split)
    left = firsts.join(gone, ["id", "pos"], "left_anti")
    rest = written(_met(left, firsts))
    remove_table(firsts)
    return written(copies.union(gone).union(_similar(rest, split)))


def kept_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """(row struct, kept, n_lines, n_removed) for every row; ``row`` holds the given columns, ``kept`` the text of the lines that stay.

    A line goes if an earlier line, by (id, line number), has a Jaccard similarity of PERCENT or more with it; that the
    earlier one goes too makes no difference. Words are separated by ASCII white space and keep their case. Lines of fewer
    than ``least_words`` words stay; with 1 every line but a blank one is compared. A null text stays null, without lines; texts
    of rows without an id stay as they are. Rows of one id are taken as one document. A document whose lines all go keeps an
    empty text. Columns of any name may be there.
    """
    gone = repeated_lines(docs, id_col, text_col, least_words).groupBy("id").agg(F.collect_set("pos").alias("gone"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    kept = F.filter(F.split("text", "\n", -1), lambda line, k: ~F.array_contains(F.col("gone"), k))
    return rows.join(gone, F.col("key") == F.col("id"), "left").select(
        "row", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).alias("n_removed"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with the remaining lines as text, and the columns n_lines and n_removed (replaced if there); see ``kept_lines``."""
    counts = "n_lines", "n_removed"
    columns = [F.col("kept").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns if c not in counts]
    return kept_lines(docs, id_col, text_col, least_words).select(*columns, *counts)
