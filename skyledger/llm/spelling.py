"""Spelling variants: words one edit apart, found by walking a relational trie level by level.

The trie is a table, one row per node with its edges. A walk's states are rows
(word, position, node, edits). States without an edit are a word's own
prefixes, known without walking; joined with the trie they take every
replacement or insertion, and from then on each level joins the state's node
with the trie and follows the one edge that the word's next letter names. A
state that arrives at a node with one word below it, or at the end of both,
names a neighbour, which is then compared letter by letter.

Two words one edit apart share the half before the edit or the half behind
it, so only edits in the back half are tried, once with words as they are and
once reversed: near the root, where every word meets every branch, no state
ever stands. Deletions are insertions seen from the shorter word.

Words above ``LONG`` letters would need a level per letter. They meet by the
hashes of all their one-letter deletions instead, and are compared likewise.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.store import discard, save

#: Letters in Latin-1: A-Z (lower-cased), a-z, U+00C0 to U+00FF; every other byte separates.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
DELETED = 31             # fixed value: a run loses a letter if this divides its hash
LONG = 64                # letters that a walked word has at most
HELD = 500_000           # distinct words that a task counts before it hands them on
_B = np.uint64(0x9E3779B97F4A7C15)
_B_INVERSE = np.uint64(pow(int(_B), -1, 2**64))


def _runs(doc_id, text) -> Counter:
    """Words of one text with their counts: maximal letter runs, some of them short of a letter."""
    out = Counter()
    if not text:
        return out
    start = zlib.crc32(b"%b:" % (b"" if doc_id is None else b"%d" % doc_id))
    # In Latin-1 a letter is a byte; all that Latin-1 lacks becomes a question mark, which separates.
    for run, n in Counter(text.encode("latin-1", "replace").translate(LETTERS).split()).items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode("utf-8"), start)
        if h % DELETED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        out[run] += n
    return out


def word_counts(docs: DataFrame, min_length: int = 7, min_count: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: words of at least ``min_length`` letters that occur at least ``min_count`` times in ``docs``."""
    def run(batches):
        held = Counter()

        def out():
            words = [w.decode("latin-1") for w in held]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                for w, n in _runs(doc_id, text).items():
                    if len(w) >= min_length:
                        held[w] += n
                if len(held) > HELD:
                    yield from out()
                    held.clear()
        yield from out()
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count))


def _node(side: str, path: str) -> str:
    """SQL for a node's number: the hash of its path. Colliding paths only add candidates, which are compared."""
    return f"xxhash64({side}, {path})"


def trie(walked: DataFrame) -> DataFrame:
    """``node, edges``: nodes that two words or more pass, each with its at most 90 edges.

    ``walked``: ``side, word``. An edge has its letter, the child, how many
    words pass, one of them, and the word that ends at the child; a word's own
    end has an edge without a letter. A word of length n passes the nodes from
    depth (n - 1) / 2 on, since only words at most one letter shorter can walk
    there towards it.
    """
    steps = (walked.select("side", "word", F.explode(F.expr("sequence(int((char_length(word) - 1) / 2), char_length(word))")).alias("at"))
             .select(F.expr(_node("side", "left(word, at)")).alias("node"), F.expr("substring(word, at + 1, 1)").alias("letter"),
                     F.expr(_node("side", "left(word, at + 1)")).alias("child"), "word",
                     F.expr("if(at + 1 = char_length(word), word, null)").alias("end")))
    edges = (steps.groupBy("node", "letter", "child")
             .agg(F.count(F.lit(1)).alias("words"), F.min("word").alias("one"), F.min("end").alias("end")))
    return (edges.groupBy("node").agg(F.sum("words").alias("through"), F.collect_list(
        F.struct("letter", "child", "words", "one", "end")).alias("edges")).filter("through > 1").select("node", "edges"))


def _arrive(states: DataFrame) -> DataFrame:
    """States after an edge ``e``: ``met`` if it names the word to compare with; others walk on if letters are left."""
    met = F.when(F.col("e.words") == 1, F.col("e.one")).when(F.col("at") == F.char_length("word"), F.col("e.end"))
    return (states.select("side", "word", "at", F.col("e.child").alias("node"), F.lit(1).alias("edits"), met.alias("met"))
            .filter("met is not null or at < char_length(word)"))


def walk(words: DataFrame) -> DataFrame:
    """``a, b``: pairs one edit apart, a before b, found by walking the trie."""
    walked = words.select("word").withColumn("side", F.lit(0)).unionByName(
        words.select(F.reverse("word").alias("word")).withColumn("side", F.lit(1)))
    nodes = save(trie(walked), "trie")
    own = (walked.select("side", "word", F.explode(F.expr("sequence(int(char_length(word) / 2), char_length(word))")).alias("at"))
           .withColumn("node", F.expr(_node("side", "left(word, at)"))).withColumn("letter", F.expr("substring(word, at + 1, 1)")))
    # An insertion of the letter that follows anyway is one after it; a replacement is tried from the smaller word.
    tried = (own.join(nodes, "node").select("side", "word", "at", "letter", F.explode("edges").alias("e")).filter("e.letter <> letter and e.letter <> ''")
             .withColumn("at", F.explode(F.expr("if(letter <> '' and e.letter > letter, array(at, at + 1), array(at))"))))
    levels = [save(_arrive(tried), "frontier")]
    while not levels[-1].filter("met is null").isEmpty():
        on = levels[-1].filter("met is null").select("side", "word", "at", "node", F.expr("substring(word, at + 1, 1)").alias("letter"))
        stepped = (on.join(nodes, "node").select("side", "word", "at", "letter", F.explode("edges").alias("e"))
                   .filter("e.letter = letter").withColumn("at", F.col("at") + 1))
        levels.append(save(_arrive(stepped), "frontier"))
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    turn = lambda c: F.when(F.col("side") == 1, F.reverse(c)).otherwise(F.col(c))
    met = found.filter("met is not null").select(turn("word").alias("x"), turn("met").alias("y")).filter(near("x", "y"))
    pairs = save(met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "pairs")
    discard(nodes, *levels)
    return pairs


def near(a: str, b: str) -> F.Column:
    """Whether two words are exactly one insertion, deletion or replacement apart; linear in their length."""
    return (F.abs(F.char_length(a) - F.char_length(b)) <= 1) & (F.levenshtein(a, b, 1) == 1)


def _deletions(word: str) -> np.ndarray:
    """Distinct hashes of a word and of the word less each letter, in linear time."""
    letters = np.frombuffer(word.encode("latin-1"), np.uint8).astype(np.uint64) + np.uint64(1)
    n = len(letters)
    powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, _B, np.uint64)])
    before = np.r_[np.uint64(0), np.cumsum(letters * powers, dtype=np.uint64)]
    less = before[:-1] + (before[-1] - before[1:]) * _B_INVERSE
    return np.unique(np.r_[less, before[-1]])


def long_pairs(words: DataFrame) -> DataFrame:
    """``a, b``: pairs one edit apart among words of any length, by the hashes of their one-letter deletions.

    Two words one edit apart have a deletion in common, or one is a deletion
    of the other. Words go by their SHA-256 until they are compared, so a row
    stays small however long the word is; a hash gathers at most the words
    that fill one gap, 90 letters and none.
    """
    def run(batches):
        for b in batches:
            for name, w in zip(b.column("name").to_pylist(), b.column("word").to_pylist()):
                h = _deletions(w).view(np.int64)
                for at in range(0, len(h), 10_000):
                    part = h[at:at + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(part), pa.string()), pa.array(part)], ["name", "h"])
    named = words.select(F.sha2("word", 256).alias("name"), "word")
    keyed = named.mapInArrow(run, "name string, h long")
    met = (keyed.withColumnRenamed("name", "x").join(keyed.withColumnRenamed("name", "y"), "h").filter("x < y").select("x", "y").distinct())
    pairs = (met.join(named.toDF("x", "a"), "x").join(named.toDF("y", "b"), "y"))
    return pairs.filter(near("a", "b")).select("a", "b")


def spelling_variants(docs: DataFrame, min_length: int = 7, min_count: int = 2, ratio: int = 10, long: int = LONG,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word of ``docs``: ``word, form, root, n, n_near, form_n``.

    Words: maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` in whole texts, A-Z
    lower-cased; where :data:`DELETED` divides the CRC-32 h of
    ``<doc_id>:<run>``, without its letter h % length. They have at least
    ``min_length`` letters and ``min_count`` occurrences ``n``. Near words
    differ by exactly one inserted, deleted or replaced letter; ``form`` is
    the near word of largest n (ties: smallest) if that is at least ``ratio``
    times the word's, else null; ``root`` follows forms to the last.

    Null texts have no words; a null id counts as no digits; repeated rows
    count as often as they stand there; an empty table gives an empty result;
    other columns are ignored.
    """
    words = save(word_counts(docs, min_length, min_count, id_col, text_col), "words")
    size = F.char_length("word")
    short, far = words.filter(size <= long), words.filter(size >= long)   # a word of `long` letters meets both kinds
    pairs = walk(short)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).toDF("word", "other")
    if not far.isEmpty():
        apart = long_pairs(far)
        both = both.unionByName(apart.select("a", "b").unionByName(apart.select("b", "a").toDF("a", "b")).toDF("word", "other")).distinct()
    counted = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = F.min(F.struct((-F.col("other_n")).alias("least"), F.col("other").alias("form")))
    beside = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    taken = F.col("best.least") <= -F.col("n") * ratio
    formed = save(words.join(beside, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(taken, F.col("best.form")).alias("form"),
        F.when(taken, -F.col("best.least")).alias("form_n")), "forms")
    # Forms have `ratio` times the occurrences, so chains are short and have no circles.
    chains = save(formed.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        up = chains.select(F.col("word").alias("root"), F.col("root").alias("up"))
        after = save(chains.join(up, "root", "left").select("word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")), "roots")
        moved = not after.filter("moved").isEmpty()
        discard(chains)
        chains = after.drop("moved")
        if not moved:
            break
    done = save(formed.join(chains, "word", "left")
                .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "spelling")
    discard(words, pairs, formed, chains)
    return done
