"""Spelling variants: words of a corpus that differ by one edit, and the form each is a variant of.

The vocabulary's acceptor is composed with a transducer of one edit and the acceptor again. Two words
that differ by one edit share the first half of the longer one or its last half, so the composition
falls apart into parts: the words that reach one initial state after half a word, read forwards or
backwards. Every part builds its minimised acceptor and enumerates the accepted pairs, which costs
time by its size and its pairs, not by the square of its words. Overfull parts start from a longer
beginning; what differs just there is told by the rest of the word.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import map_batches, picked, slices, staged

LEAST_LENGTH = 5
LEAST_COUNT = 3
DROP_EVERY = 97
RATIO = 2
PART_WORDS = 20_000
HELD_WORDS = 300_000
# Letters of words (A-Z, a-z, U+00C0 to U+00FF) as Latin-1, A-Z lower-cased; others part words.
_IS_LETTER = [65 <= c <= 90 or 97 <= c <= 122 or c >= 0xC0 for c in range(256)]
LETTERS = bytes((c + 32 if 65 <= c <= 90 else c) if _IS_LETTER[c] else 32 for c in range(256))


def letter_runs(text: str | None) -> list[bytes]:
    """The words of a text in their order, as Latin-1."""
    return text.encode("latin-1", "replace").translate(LETTERS).split() if text else []


def _kept(word: bytes, start: int, every: int | None) -> bytes:
    """The word, or what is left of it where the check sum of id and word says so."""
    if every:
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
        if h % every == 0:
            at = h % len(word)
            return word[:at] + word[at + 1 :]
    return word


def vocabulary(
    df: DataFrame, id: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT, drop_every: int | None = DROP_EVERY,
) -> DataFrame:
    """(word, n) of all texts. Tasks sum what they meet before the shuffle, in bounded tables."""
    rows = picked(df, id=id, text=text).select(F.coalesce(F.col("id").cast("string"), F.lit("")), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            words = pa.array([word.decode("latin-1") for word in found], pa.string())
            batch = pa.RecordBatch.from_arrays([words, pa.array(list(found.values()), pa.int64())], names=["word", "n"])
            found.clear()
            return batch

        for batch in slices(batches):
            for own, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                start = zlib.crc32(f"{own}:".encode())
                for word, many in Counter(letter_runs(body)).items():
                    word = _kept(word, start, drop_every)
                    if len(word) >= least_length:
                        found[word] = found.get(word, 0) + many
                if len(found) >= HELD_WORDS:
                    yield flush()
        yield flush()

    words = map_batches(rows, run, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class Acceptor:
    """Minimised acceptor of sorted distinct words, built word by word.

    States are numbered after all their successors. ``steps[s]`` holds (character, state, words of s
    before those of the step), so the sum of a path's numbers is its word's place in the order.
    """

    def __init__(self, words: Sequence[str]):
        self.final: list[bool] = []
        self.steps: list[tuple[tuple[str, int, int], ...]] = []
        self.many: list[int] = []
        self._known: dict[tuple, int] = {}
        last, path = "", [[False, []]]  # open states along the last word: final, closed steps
        for word in words:
            same, most = 0, min(len(last), len(word))
            while same < most and last[same] == word[same]:
                same += 1
            self._close(path, last, same)
            path.extend([False, []] for _ in range(len(word) - same))
            path[-1][0] = True
            last = word
        self._close(path, last, 0)
        self.root = self._state(*path[0])

    def _close(self, path: list, word: str, keep: int) -> None:
        while len(path) > keep + 1:
            state = self._state(*path.pop())
            path[-1][1].append((word[len(path) - 1], state))

    def _state(self, final: bool, steps: list[tuple[str, int]]) -> int:
        key = (final, *steps)
        found = self._known.get(key)
        if found is None:
            before, numbered = int(final), []
            for char, state in steps:
                numbered.append((char, state, before))
                before += self.many[state]
            found = self._known[key] = len(self.final)
            self.final.append(final)
            self.steps.append(tuple(numbered))
            self.many.append(before)
        return found

    def common(self, a: int, b: int, at_a: int, at_b: int, but: str | None = None) -> Iterator[tuple[int, int]]:
        """Places of the words that both states accept; of b, words that start with ``but`` are left out."""
        todo = [(a, b, at_a, at_b)]
        while todo:
            a, b, at_a, at_b = todo.pop()
            if a == b and but is None:
                for k in range(self.many[a]):
                    yield at_a + k, at_b + k
                continue
            if self.final[a] and self.final[b]:
                yield at_a, at_b
            other = {char: (state, before) for char, state, before in self.steps[b]}
            for char, state, before in self.steps[a]:
                if char != but and char in other:
                    to, before_b = other[char]
                    todo.append((state, to, at_a + before, at_b + before_b))
            but = None

    def pairs(self) -> list[tuple[int, int]]:
        """Places of all pairs of words one edit apart, each pair once.

        A replaced character takes two steps of a state, an inserted one a step of the longer word
        only; it is read as early as the words differ. From there on both read the same.
        """
        apart: list[list[tuple[int, int]]] = []
        for s, steps in enumerate(self.steps):
            found = []
            for k, (char, state, before) in enumerate(steps):
                found += [(before + i, before + j) for i, j in apart[state]]
                for _, other, after in steps[k + 1 :]:
                    found += self.common(state, other, before, after)
                found += self.common(state, s, before, 0, char)
            apart.append(found)
        return apart[self.root]


def _parts(words: DataFrame, part_words: int) -> DataFrame:
    """(longest, side, kind, at, start, own, n): a row per word and part that it takes part in.

    ``own`` is the word as it is read, ``start`` what names the initial state. Parts of kind ``d``
    hold the words that are equal but for the character at ``at``.
    """
    size = F.length("word")
    sides = F.array(F.struct(F.lit("f").alias("side"), F.col("word").alias("own")), F.struct(F.lit("b").alias("side"), F.reverse("word").alias("own")))
    rows = words.select("n", F.explode(sides).alias("read"), F.explode(F.array(size, size + 1)).alias("longest"))
    rows = rows.select("longest", "read.side", F.floor(F.col("longest") / 2).cast("int").alias("at"), "read.own", "n")
    with_start = lambda df: df.withColumn("start", F.expr("substring(own, 1, at)"))
    key = ["longest", "side", "at", "start"]
    names = ["longest", "side", "kind", "at", "start", "own", "n"]
    rows, done = staged(with_start(rows), "word-parts"), []
    while True:
        sizes = staged(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("many"), F.max(F.length("own")).alias("most")).where("many > 1 and most = longest"), "part-sizes")
        kept = rows.join(sizes.where(F.col("many") <= part_words).select(*key), key, "left_semi")
        done.append(kept.withColumn("kind", F.lit("p")).select(*names))
        large = sizes.where(F.col("many") > part_words).select(*key)
        if large.isEmpty():
            return reduce(DataFrame.unionByName, done)
        hot = staged(rows.join(large, key, "left_semi"), "hot-parts")
        rest = F.when(F.length("own") == F.col("longest"), F.expr("substring(own, at + 2)")).otherwise(F.expr("substring(own, at + 1)"))
        done.append(hot.withColumns({"kind": F.lit("d"), "start": F.concat("start", F.lit(" "), rest)}).select(*names))
        rows = staged(with_start(hot.where(F.length("own") > F.col("at")).withColumn("at", F.col("at") + 1)), "word-parts")


def _pairs_of(longest: int, side: str, kind: str, at: int, words: list[str]) -> Iterator[tuple[int, int]]:
    """Pairs of a part's sorted words that belong to it: no other part gives them too."""
    half = longest // 2
    for i, j in Acceptor([word[at:] for word in words]).pairs():
        a, b = words[i], words[j]
        if len(a) < longest > len(b):
            continue
        if kind == "d" and a[at : at + 1] == b[at : at + 1]:
            continue
        if side == "b" and a[len(a) - half :] == b[len(b) - half :]:
            continue
        yield i, j


def near_words(words: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """(word, n_near, best_n, best): per word of ``words`` (word, n) with a near one, in several rows.

    Every part sums up what its pairs say of a word; ``best`` has the greatest n, of equal ones the
    least word. No pair is shuffled.
    """
    key = ["longest", "side", "kind", "at", "start"]
    parts = _parts(words, part_words)
    dealt = parts.repartition(*key).sortWithinPartitions(*key, "own").select(*key, "own", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, counts = None, [], []
        out: list[tuple[str, int, int, str]] = []

        def close() -> None:
            if len(held) < 2:
                return
            longest, side, kind, at, _ = part
            turned = held if side == "f" else [word[::-1] for word in held]
            near: dict[int, tuple[int, int, str]] = {}
            for i, j in _pairs_of(longest, side, kind, at, held):
                for a, b in ((i, j), (j, i)):
                    many, n, best = near.get(a, (0, 0, ""))
                    if counts[b] > n or (counts[b] == n and turned[b] < best):
                        n, best = counts[b], turned[b]
                    near[a] = many + 1, n, best
            out.extend((turned[a], *found) for a, found in near.items())

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * 4
            out.clear()
            types = pa.string(), pa.int64(), pa.int64(), pa.string()
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)], names=["word", "n_near", "best_n", "best"]
            )

        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            for *named, own, n in zip(*columns, strict=True):
                if named != part:
                    close()
                    part, held, counts = named, [], []
                held.append(own)
                counts.append(n)
            if len(out) > 20_000:
                yield flush()
        close()
        yield flush()

    return map_batches(dealt, run, "word string, n_near long, best_n long, best string")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): the end of each chain, whose steps double every round."""
    found = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        moved = staged(found.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), "roots")
        found = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return found


def spelling_variants(
    df: DataFrame, id: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
    drop_every: int | None = DROP_EVERY, ratio: int = RATIO, part_words: int = PART_WORDS,
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are runs of Latin letters of at least ``least_length`` code points that occur
    ``least_count`` times over all texts (repeated rows count again); null and empty texts have none,
    an empty table gives no rows and other columns change nothing. Where the check sum of
    ``id:word`` (a null id: empty) is divisible by ``drop_every``, the word loses one letter first.
    ``form`` is the word's most frequent near word, of equal ones the least, if that occurs
    ``ratio`` (2 at least) times as often, else null; ``root`` is where forms lead to in the end.
    Words of any length count; one part holds at most ``part_words`` of them, or one per letter.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their variants")
    words = staged(vocabulary(df, id, text, least_length, least_count, drop_every), "words")
    first = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("first")
    near = near_words(words, part_words).groupBy("word").agg(F.sum("n_near").alias("n_near"), first)
    joined = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), (-F.col("first.less")).alias("best_n"), F.col("first.word").alias("best")
    )
    often = F.col("best_n") >= ratio * F.col("n")
    formed = staged(joined.select("word", F.when(often, F.col("best")).alias("form"), "n", "n_near", F.when(often, F.col("best_n")).alias("form_n")), "forms")
    roots = _roots(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
