"""Spelling variants: near words by a bit-sliced position index, and the form each one goes to.

Two words are near if one code point inserted, deleted or replaced makes them equal. A block of
words is indexed by bit slices: for every position and letter a bitset of the words that have
this letter there. A query is read letter by letter, and recurrences on whole bitsets track
which words agree so far without an error, and with one: a replaced letter (same position), a
letter more or less (the slices of the next or the former position). All queries of a block are
read at the same time, 64 words to a machine word.

Words meet in blocks by what an edit leaves alone. If the shorter of two near words has m
letters, they share the first or the last m // 2. So a word goes to the groups of its first and
its last half, for partners as long as itself and one shorter. A group above ``GROUP_WORDS`` is
divided again by the same rule, applied to the letters between the shared ones, until the groups
are small or nothing is left to divide: then the words of a group differ in two letters at most,
and the alphabet bounds it. No pair of near words is lost, and no word has a cap on partners.

The form of a word is its near word of largest n (ties: the first in code-point order) if that
has twice the n or more; the root follows the forms by pointer doubling, in as many rounds as
the logarithm of the longest path.

Texts that are null or empty have no words, so an empty table and one of such texts give no
rows. Repeated rows count again; a null doc_id is written as nothing. Further columns are
ignored. A text is read whole, however long.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankpulse.llm.common import chunks, pick, small_side, table
from bankpulse.operators.ordering import written

MIN_LETTERS = 5
MIN_OCCURRENCES = 3
#: A form has this many times the occurrences of its variant.
MARGIN = 2
#: One run in so many loses a letter (by checksum of document and run); 0: none.
DAMAGE = 97
#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 200_000
#: Words of a group above which it is divided, and words and letters of a block.
GROUP_WORDS, BLOCK_LETTERS = 2048, 1 << 22

# letters A-Z in lower case, a-z, and the bytes of other characters; all else parts words
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
# characters of several bytes other than U+00C0 to U+00FF, whose first byte is C3
_FOREIGN = re.compile(rb"[\xc2\xc4-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf7][\x80-\xbf]{3}")


def runs_of(text: bytes) -> list[bytes]:
    """Maximal runs of a-z, A-Z and U+00C0 to U+00FF, A-Z in lower case."""
    return _FOREIGN.sub(b" ", text.translate(_LETTERS)).split()


def damaged(run: bytes, checksum: int) -> bytes:
    """The run without the code point that the checksum points at."""
    letters = run.decode()
    at = checksum % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def count_words(text: bytes, name: bytes, total: Counter, min_letters: int = MIN_LETTERS, damage: int = DAMAGE) -> None:
    """Add the words of a document, named by its id, to ``total``."""
    start = zlib.crc32(name + b":")
    for run, times in Counter(runs_of(text)).items():
        if len(run) < min_letters:
            continue
        if damage and (checksum := zlib.crc32(run, start)) % damage == 0:
            run = damaged(run, checksum)
        if len(run) - run.count(b"\xc3") >= min_letters:
            total[run] += times


def vocabulary(docs: DataFrame, min_occurrences: int = MIN_OCCURRENCES, min_letters: int = MIN_LETTERS, damage: int = DAMAGE) -> DataFrame:
    """word, n: words are counted within the tasks first, so a frequent one is a row per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.binary()).cast(pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"]
            )

        for chunk in chunks(batches):
            for text, name in zip(chunk.column("text").to_pylist(), chunk.column("name").to_pylist(), strict=True):
                count_words(text or b"", name.encode(), total, min_letters, damage)
                if len(total) >= HELD_WORDS:
                    yield rows()
                    total.clear()
        if total:
            yield rows()

    texts = pick(docs, "doc_id", "text").select(
        F.col("text").cast("binary").alias("text"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name")
    )
    counted = texts.mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_occurrences)


def _key(low: Column, a: Column, b: Column) -> Column:
    """Name of a group: letters left to the shorter of a pair, and the shared first a and last b."""
    word = F.col("word")
    return F.concat_ws("|", low, a, b, F.left(word, a), F.right(word, b))


def _halves(rows: DataFrame) -> DataFrame:
    """The rows (word, n, low, a, b) twice, with half of the ``low`` letters between the shared
    ones added to the first or to the last."""
    half = F.floor(F.col("low") / 2).cast("int")
    side = F.explode(F.array(F.struct(half.alias("x"), F.lit(0).alias("y")), F.struct(F.lit(0).alias("x"), half.alias("y"))))
    grown = rows.withColumn("half", half).withColumn("side", side).select(
        "word", "n", (F.col("low") - F.col("half")).alias("low"),
        (F.col("a") + F.col("side.x")).alias("a"), (F.col("b") + F.col("side.y")).alias("b"),
    )
    return grown.withColumn("key", _key(F.col("low"), F.col("a"), F.col("b")))


def grouped(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """word, n, low, a, b, key: the words in all groups where they may meet a near one."""
    length = F.char_length("word")
    low = F.explode(F.array(length - 1, length).cast("array<int>"))
    start = words.select("word", "n", low.alias("low"), F.lit(0).alias("a"), F.lit(0).alias("b"))
    rows = written(_halves(start))
    while True:
        sizes = written(rows.groupBy("key", "low").agg(F.count("*").alias("size")).where(
            (F.col("size") > group_words) & (F.col("low") >= 2)
        ).select("key"))
        if sizes.isEmpty():
            return rows
        large = small_side(sizes)
        rows = written(rows.join(large, "key", "left_anti").unionByName(_halves(rows.join(large, "key", "left_semi"))))


class SlicedIndex:
    """Bit slices of a block of words (Latin-1 bytes), each in a group; only words of a group meet."""

    def __init__(self, words: list[bytes], groups: np.ndarray) -> None:
        self.count = len(words)
        self.lengths = np.array([len(w) for w in words])
        longest = int(self.lengths.max(initial=0))
        padded = np.frombuffer(b"".join(w.ljust(longest, b"\0") for w in words), np.uint8).reshape(self.count, longest)
        present = np.unique(padded)
        present = present[present > 0]
        rank = np.zeros(256, np.int64)
        rank[present] = np.arange(len(present))
        self.codes = rank[padded]
        # has[p, c]: words with letter c at position p; one position more on each side is empty
        self.has = np.zeros((longest + 2, max(1, len(present)), self._cells()), np.uint64)
        for p in range(longest):
            self.has[p + 1, : len(present)] = self._bits(padded[:, p] == present[:, None])
        self.reaches = self._bits(self.lengths > np.arange(longest + 2)[:, None])  # longer than p
        self.of_length = self._bits(self.lengths == np.arange(longest + 2)[:, None])
        self.groups = groups
        self.members = self._bits(groups == np.arange(groups.max(initial=-1) + 1)[:, None])

    def _cells(self) -> int:
        return -(-self.count // 64)

    def _bits(self, flags: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(flags), self._cells() * 64), bool)
        wide[:, : self.count] = flags
        return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word) of places in the block at exactly one edit."""
        order = np.argsort(-self.lengths, kind="stable")  # queries still being read come first
        lengths, codes = self.lengths[order], self.codes[order]
        same = self.members[self.groups[order]]  # read so far without an error
        replaced, shorter = np.zeros_like(same), np.zeros_like(same)
        longer = same & self.reaches[0]
        found = np.zeros_like(same)
        for j in range(int(lengths.max(initial=0)) + 1):
            ended = slice(np.searchsorted(-lengths, -j), np.searchsorted(-lengths, -j, side="right"))
            found[ended] = (
                (replaced[ended] & self.of_length[j]) | (longer[ended] & self.of_length[j + 1])
                | (shorter[ended] & self.of_length[j - 1] if j else 0)
            )
            reading = slice(0, ended.start)
            if not ended.start:
                break
            letter = codes[reading, j]
            here, before, after = self.has[j + 1, letter], self.has[j, letter], self.has[j + 2, letter]
            exact = same[reading]
            replaced[reading] = (replaced[reading] & here) | (exact & self.reaches[j] & ~here)
            shorter[reading] = (shorter[reading] & before) | exact
            same[reading] = exact & here
            longer[reading] = (longer[reading] & after) | (same[reading] & self.reaches[j + 1])
        query, cell = np.nonzero(found)
        bits = np.unpackbits(found[query, cell].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, bit = np.nonzero(bits)
        return order[query[row]], cell[row] * 64 + bit


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, near, near_n from rows sorted by key; groups stay whole, small ones share a block."""
    words, middles, counts, groups, longest = [], [], [], [], 0

    def pairs() -> Iterator[pa.RecordBatch]:
        one, two = SlicedIndex(middles, np.array(groups)).near()
        if len(one):
            names = pa.array(words, pa.string())
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(one)), names.take(pa.array(two)), pa.array(np.array(counts, np.int64)[two])], ["word", "near", "near_n"]
            )

    key, first = None, 0  # of the group being read
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("key", "word", "n", "a", "b"))
        for name, word, n, a, b in zip(*columns, strict=True):
            if name != key:
                if len(words) - first == 1:  # alone in its group
                    for held in (words, middles, counts, groups):
                        held.pop()
                if len(words) >= GROUP_WORDS or len(words) * longest > BLOCK_LETTERS:
                    yield from pairs()
                    words, middles, counts, groups, longest = [], [], [], [], 0
                key, first = name, len(words)
                number = groups[-1] + 1 if groups else 0
            words.append(word)
            middles.append(word[a : len(word) - b].encode("latin-1"))
            counts.append(n)
            groups.append(number)
            longest = max(longest, len(middles[-1]))
    if len(words) > 1:
        yield from pairs()


def near_words(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """word, near, near_n: both directions of every two near words once."""
    rows = grouped(words, group_words).select("key", "word", "n", "a", "b")
    found = rows.repartition("key").sortWithinPartitions("key").mapInArrow(_block_pairs, "word string, near string, near_n long")
    return found.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root for rows (word, form): the end of the path of forms, which has no cycles.
    A word jumps as far as its target has jumped, so paths halve each round; words whose target
    has no form are over and only serve as targets."""
    rows = written(forms.select("word", F.col("form").alias("at"), F.lit(False).alias("over")))
    while not rows.where(~F.col("over")).isEmpty():
        jumps = rows.select(F.col("word").alias("here"), F.col("at").alias("next"))
        moved = rows.where(~F.col("over")).join(jumps, F.col("at") == F.col("here"), "left").select(
            "word", F.coalesce("next", "at").alias("at"), F.col("next").isNull().alias("over")
        )
        rows = written(rows.where("over").union(moved))
    return rows.select("word", F.col("at").alias("root"))


def variants(words: DataFrame, margin: int = MARGIN, group_words: int = GROUP_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n for a table of distinct words with their counts n."""
    words = written(words.select("word", "n"))
    best = F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), "near"))
    near = near_words(words, group_words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    is_form = F.col("best.near_n") >= margin * F.col("n")
    found = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, F.col("best.near_n")).alias("form_n"),
    ))
    ends = roots(found.where(F.col("form").isNotNull()).select("word", "form"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op12_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants(vocabulary(table(spark, folder, "documents")))


# Near words share the word that lacks one letter: at the same place of both (replaced), or one word is it.
ORACLE = f"""
WITH RECURSIVE crc AS (
  SELECT list(r ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS r
    FROM range(256) x(b))
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
  FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS times, hex(encode(concat(doc_id::VARCHAR, ':', run))) AS h
  FROM runs WHERE length(run) >= {MIN_LETTERS} GROUP BY doc_id, run
), summed AS (
  SELECT run, times, xor(list_reduce(
         list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: (16 * (instr('0123456789ABCDEF', array_extract(h, 2 * i + 1)) - 1) + instr('0123456789ABCDEF', array_extract(h, 2 * i + 2)) - 1)::BIGINT)),
         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM counted, crc
), made AS (
  SELECT times, CASE WHEN crc % {DAMAGE} = 0 THEN concat(substr(run, 1, crc % length(run)), substr(run, crc % length(run) + 2)) ELSE run END AS word
  FROM summed
), words AS (
  SELECT word, sum(times)::BIGINT AS n FROM made WHERE length(word) >= {MIN_LETTERS} GROUP BY word HAVING sum(times) >= {MIN_OCCURRENCES}
), places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words
), lacking AS (SELECT word, n, i, concat(substr(word, 1, i - 1), substr(word, i + 1)) AS rest FROM places
), near AS (
  SELECT x.word, y.word AS near, y.n AS near_n FROM lacking x JOIN lacking y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM lacking x JOIN words y ON x.rest = y.word
  UNION SELECT y.word, x.word, x.n FROM lacking x JOIN words y ON x.rest = y.word
), best AS (
  SELECT word, count(*) AS n_near, arg_max(near, (near_n, -place)) AS near, max(near_n) AS near_n
  FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY encode(near)) AS place FROM near) GROUP BY word
), forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {MARGIN} * n THEN near END AS form,
         CASE WHEN near_n >= {MARGIN} * n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), path AS (
  SELECT word, word AS at FROM forms
  UNION ALL
  SELECT path.word, forms.form FROM path JOIN forms ON forms.word = path.at WHERE forms.form IS NOT NULL
), ends AS (SELECT path.word, path.at AS root FROM path JOIN forms ON forms.word = path.at WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n FROM forms JOIN ends USING (word)
"""
