"""Collocations of every language, by best-first growth of phrases from their first word.

Counting. Tasks turn texts into chunks: numbers of words, with the chunk's own dictionary. Only what the
counts rule out is left behind: words below the least frequency become gaps, as no phrase around
them can reach it, and so do pairs. What is left are windows, two and more frequent pairs in a row, cut after the
longest phrase and summed over all chunks. A chunk deals its words, and then its pairs, to places by their hash, a
packed row for each place, which adds them up and tells the chunk which are frequent: no task holds the dictionary of the corpus.

Growth. A phrase's score is at most 1000 n / f(first word), whatever follows: cut after that word, its own
frequency is no more than that of the rest. First words wait in the order of this bound, the rarest first, and are
expanded in bands that double in pairs. The band's phrases get a bound of their own from the counts of their
prefix and last word; what reaches the language's threshold is scored on all its cuts, with the counts
of the parts looked up, and dropped if a phrase one word longer, on either side, is as frequent: a longer
one that holds it has the same count as all between. The threshold is the score at the last rank so far. A language
is settled when no bound of an unexpanded word reaches it, so that ties count in.

NULL text is empty, NULL language is `und`. Repeated rows count as often as they occur. Words and pieces are
whatever the separators leave, of any length; an empty table has no phrases. Other columns are not read.
Frequencies and products are exact (38 digits).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.arrow import SLICE_BYTES, give_back, slices
from millrace.llm.mapped import thin, thinned, wide, widened
from millrace.llm.words import mix
from millrace.operators.positions import running_total
from millrace.session import ship_package
from millrace.sources.tables import settle

LONGEST = 5
CHUNK_WORDS = 1 << 20
PLACE_WORDS = 6 << 20  # words of text for each place where words meet; pairs meet in twice as many
SENT_ROWS = 100_000  # phrases that a join may broadcast, at most 100 bytes each
_SLOTS = [f"w{k}" for k in range(1, LONGEST + 1)]
# A-Z to a-z, the ends of pieces to a line break, tabs to spaces.
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")


class _Chunk:
    """Words of one language as numbers: 0 ends a piece, the others count from 1."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {b"\n": 0, b"": -1}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, texts: list[str]) -> None:
        data = "\n".join(texts).encode().translate(_PLAIN).replace(b"\n", b" \n ")
        tokens, numbers = data.split(b" "), self.numbers
        codes = list(map(numbers.get, tokens))
        if None in codes:
            for t in dict.fromkeys(t for t, c in zip(tokens, codes) if c is None):
                numbers[t] = len(numbers) - 1
            codes = list(map(numbers.get, tokens))
        found = np.array([*codes, 0], np.int64)
        self.parts.append(found[found >= 0].astype(np.uint32))
        self.size += len(self.parts[-1])

    def row(self) -> tuple:
        """The words by their checksum, which deals them into places, and the text as numbers of that order."""
        codes, words = np.concatenate(self.parts), list(self.numbers)[2:]
        order = sorted(range(len(words)), key=lambda k: (zlib.crc32(words[k]), words[k]))
        renumbered = np.zeros(len(words) + 1, np.uint32)
        renumbered[np.array(order, np.int64) + 1] = np.arange(1, len(words) + 1)
        codes = renumbered[codes]
        counts = np.bincount(codes, minlength=len(words) + 1)[1:]
        width, data = thin(codes)
        return b" ".join([words[k] for k in order]), *thinned([counts]), int(counts.sum()), width, data


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, _Chunk] = {}

    def flush() -> pa.RecordBatch:
        rows = [(lang, *chunk.row()) for lang, chunk in held.items()]
        types = [pa.string(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.int64(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                          names=["lang", "words", "counts", "widths", "n", "width", "codes"])

    for batch in batches:
        for some, texts in slices(batch, batch.column(1), SLICE_BYTES):
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(some.column(0).to_pylist(), texts.to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, own in by_lang.items():
                held.setdefault(lang, _Chunk()).add(own)
            if sum(chunk.size for chunk in held.values()) >= CHUNK_WORDS:
                yield flush()
                held.clear()
    if held:
        yield flush()
    give_back()


def _deal_words(places: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A chunk's words with their counts, a row for each place."""
        for batch in batches:
            for lang, chunk, data, packed, widths in zip(*(c.to_pylist() for c in batch.columns)):
                words = data.split(b" ") if data else []
                counts, = widened(packed, widths)
                place = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) * places >> 32
                edges = np.flatnonzero(np.diff(place, prepend=-1, append=-1))
                rows = [(lang, int(place[a]), chunk, b" ".join(words[a:b]), *thinned([counts[a:b]]))
                        for a, b in zip(edges[:-1], edges[1:])]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [
                        pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32())])],
                        names=["lang", "place", "chunk", "words", "counts", "widths"])
        give_back()

    return run


def _merge_words(least: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        """A place's frequent words, numbered from 1; beside them, for each chunk the numbers of its words there, 0 for others."""
        numbers: dict[bytes, int] = {}
        codes, counts = [], []
        for data, packed, widths in zip(frame["words"], frame["counts"], frame["widths"]):
            codes.append(np.array([numbers.setdefault(w, len(numbers)) for w in data.split(b" ")], np.int64))
            counts.append(widened(packed, widths)[0].astype(np.int64))
        total, words = np.zeros(len(numbers), np.int64), list(numbers)
        for own, n in zip(codes, counts):
            total[own] += n  # a chunk has a word once
        often = sorted(np.flatnonzero(total >= least).tolist(), key=lambda k: (zlib.crc32(words[k]), words[k]))
        rank = np.zeros(len(words), np.uint64)
        rank[often] = np.arange(1, len(often) + 1)
        replies = [thinned([rank[own]]) for own in codes]
        out = pd.DataFrame({"chunk": pd.array([*frame["chunk"], None], "Int64"), "ranks": [*(r for r, _ in replies), None],
                            "widths": [*(w for _, w in replies), None], "words": [None] * len(replies) + [[words[k].decode() for k in often]],
                            "f": [None] * len(replies) + [total[often].tolist()]})
        out["lang"], out["place"] = frame["lang"].iloc[0], frame["place"].iloc[0]
        give_back()
        return out

    return run


def _recode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks with their frequent words only: 0 for all others, neighbouring zeros as one."""
    for batch in batches:
        for chunk, width, data, known in zip(*(batch.column(k).to_pylist() for k in range(4))):
            codes, every = wide(width, data).astype(np.int64), [np.zeros(1, np.int64)]
            for x in sorted(known, key=lambda x: x["place"]):
                rank = widened(x["ranks"], x["widths"])[0].astype(np.int64)
                every.append(np.where(rank > 0, rank + x["before"], 0))
            ids = np.concatenate(every)
            often = ids > 0
            codes = np.where(often, np.cumsum(often), 0)[codes]
            codes = codes[(codes > 0) | (np.concatenate(([1], codes[:-1])) > 0)]
            size, thinner = thin(codes.astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk]), pa.array([ids[often].astype("<i8").tobytes()], pa.binary()), pa.array([size], pa.int32()),
                 pa.array([thinner], pa.binary())], names=["chunk", "ids", "width", "codes"])
    give_back()


def _opened(batch: pa.RecordBatch) -> Iterator[tuple]:
    for chunk, ids, width, data, *more in zip(*(c.to_pylist() for c in batch.columns)):
        yield chunk, np.concatenate(([0], np.frombuffer(ids, "<i8"))), wide(width, data).astype(np.int64), *more


def _pairs_of(ids: np.ndarray, codes: np.ndarray, places: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's distinct pairs, as first * len(ids) + second, by their place; their counts and places."""
    a, b = codes[:-1], codes[1:]
    both = (a > 0) & (b > 0)
    keys, counts = np.unique(a[both] * len(ids) + b[both], return_counts=True)
    first, second = (ids[k].astype(np.uint64) for k in np.divmod(keys, len(ids)))
    place = (mix(mix(first) * np.uint64(3) + second) % np.uint64(places)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    return keys[order], counts[order], place[order]


def _deal_pairs(places: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A chunk's distinct pairs with their counts, a row for each place."""
        for batch in batches:
            for chunk, ids, codes in _opened(batch):
                keys, counts, place = _pairs_of(ids, codes, places)
                first, second = ids[keys // len(ids)], ids[keys % len(ids)]
                edges = np.flatnonzero(np.diff(place, prepend=-1, append=-1))
                rows = [(int(place[a]), chunk, *thinned([np.diff(first[a:b], prepend=0), second[a:b], counts[a:b]]))
                        for a, b in zip(edges[:-1], edges[1:])]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [
                        pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32())])], names=["place", "chunk", "pairs", "widths"])
        give_back()

    return run


def _merge_pairs(least: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        """A place's frequent pairs; beside them, for each chunk which of its pairs there are, a bit each."""
        parts = [widened(*x) for x in zip(frame["pairs"], frame["widths"])]
        sizes = [len(p[0]) for p in parts]
        first = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts]).astype(np.int64)
        second, counts = (np.concatenate([p[k] for p in parts]).astype(np.int64) for k in (1, 2))
        del parts
        order = np.lexsort((second, first))
        first, second, counts = first[order], second[order], counts[order]
        start = np.flatnonzero(np.diff(first, prepend=-1) | np.diff(second, prepend=-1))
        total = np.add.reduceat(counts, start)
        often = total >= least
        known = np.empty(len(order), bool)
        known[order] = np.repeat(often, np.diff(start, append=len(order)))
        bits = [np.packbits(part).tobytes() for part in np.split(known, np.cumsum(sizes)[:-1])]
        at = start[often]
        found = pd.DataFrame({"w1": first[at], "w2": second[at], "a": total[often]}, dtype="Int64")
        out = pd.concat([pd.DataFrame({"chunk": pd.array(frame["chunk"], "Int64"), "bits": bits}), found], ignore_index=True)
        out["place"], out["bits"] = frame["place"].iloc[0], out["bits"].astype(object).where(out["bits"].notna(), None)
        give_back()
        return out

    return run


def _windows(places: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A chunk's distinct windows of three words or more, 0 where the frequent pairs end."""
        for batch in batches:
            for _, ids, codes, known in _opened(batch):
                keys, _, place = _pairs_of(ids, codes, places)
                sizes = np.bincount(place, minlength=places)
                often = [np.unpackbits(np.frombuffer(x["bits"], "u1"), count=int(sizes[x["place"]]))
                         for x in sorted(known, key=lambda x: x["place"])]
                keys = np.sort(keys[np.concatenate(often) > 0])
                if not len(keys):
                    continue
                padded = np.concatenate((codes, np.zeros(LONGEST, np.int64)))
                pair = padded[:-1] * len(ids) + padded[1:]
                linked = (padded[:-1] > 0) & (padded[1:] > 0)
                at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
                linked &= keys[at] == pair
                starts = np.flatnonzero(linked[:len(codes)] & linked[1:len(codes) + 1])
                open_, columns, code = np.ones(len(starts), bool), [padded[starts]], padded[starts]
                for k in range(1, LONGEST):
                    open_ &= linked[starts + k - 1]
                    columns.append(np.where(open_, padded[starts + k], 0))
                    code = np.unique(code, return_inverse=True)[1] * len(ids) + columns[-1]
                _, one, counts = np.unique(code, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([*[pa.array(ids[c[one]]) for c in columns], pa.array(counts)], names=[*_SLOTS, "n"])
        give_back()

    return run


def _longs(names: list[str]) -> str:
    return ", ".join(f"{n} long" for n in names)


def _floor_ratio(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (left right)), exactly."""
    a, n, left, right = (x.cast("decimal(19,0)") for x in (a, n, left, right))
    return F.call_function("div", a * n * F.lit(1000).cast("decimal(4,0)"), left * right)


def phrase_counts(docs: DataFrame, least: int, text_col: str, lang_col: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(lang, n); (id, lang, word, f) of frequent words; (w1, w2, a) of frequent pairs; (w1 ... w5, n) of windows (runs jobs)."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")), F.coalesce(F.col(text_col), F.lit("")))
    read = rows.mapInArrow(
        _read, "lang string, words binary, counts binary, widths array<int>, n long, width int, codes binary")
    chunks = settle(read.withColumn("chunk", F.monotonically_increasing_id()), "word-chunks")
    langs = settle(chunks.groupBy("lang").agg(F.sum("n").alias("n")), "word-totals")
    size = langs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # A word moves once for each chunk that has it, and so does a pair: its sum and its chunks meet in the same place.
    dealt = chunks.select("lang", "chunk", "words", "counts", "widths").mapInArrow(
        _deal_words(1 + size // PLACE_WORDS), "lang string, place long, chunk long, words binary, counts binary, widths array<int>")
    met = settle(dealt.groupBy("lang", "place").applyInPandas(
        _merge_words(least), "chunk long, ranks binary, widths array<int>, words array<string>, f array<long>, lang string, place long"),
        "word-places")
    sizes = met.filter("chunk is null").select("lang", "place", F.size("words").alias("size"))
    before = settle(running_total(sizes, "size", "lang", "place").select(
        "lang", "place", (F.col("upto") - F.col("size")).alias("before")), "word-numbers")
    words = settle(met.filter("chunk is null").join(before, ["lang", "place"]).select(
        "lang", "before", F.posexplode(F.arrays_zip("words", "f")).alias("at", "x")).select(
        (F.col("before") + F.col("at") + 1).alias("id"), "lang", F.col("x.words").alias("word"), F.col("x.f").alias("f")), "words")
    known = met.filter("chunk is not null").join(before, ["lang", "place"]).groupBy("chunk").agg(
        F.collect_list(F.struct("place", "before", "ranks", "widths")).alias("known"))
    joined = chunks.select("chunk", "width", "codes").join(known, "chunk").select("chunk", "width", "codes", "known")
    coded = settle(joined.mapInArrow(_recode, "chunk long, ids binary, width int, codes binary"), "coded-chunks")
    places = 1 + 2 * size // PLACE_WORDS
    met = settle(coded.mapInArrow(_deal_pairs(places), "place long, chunk long, pairs binary, widths array<int>").groupBy(
        "place").applyInPandas(_merge_pairs(least), "chunk long, bits binary, w1 long, w2 long, a long, place long"), "pair-places")
    pairs = settle(met.filter("chunk is null").select("w1", "w2", "a"), "frequent-pairs")
    known = met.filter("chunk is not null").groupBy("chunk").agg(F.collect_list(F.struct("place", "bits")).alias("known"))
    met = coded.join(known, "chunk").select("chunk", "ids", "width", "codes", "known")
    windows = settle(met.mapInArrow(_windows(places), _longs([*_SLOTS, "n"])).groupBy(*_SLOTS).agg(F.sum("n").alias("n")), "windows")
    return langs, words, pairs, windows


def _frontier(words: DataFrame, pairs: DataFrame, first_pairs: int) -> DataFrame:
    """(w1, lang, f, band): first words, the rarest in band 0; a band's end has twice the pairs of the one before."""
    begun = pairs.groupBy(F.col("w1").alias("id")).agg(F.count(F.lit(1)).alias("pairs")).join(words, "id")
    placed = settle(running_total(begun.select("id", "lang", "f", "pairs"), "pairs", "lang", "f", "id"), "first-words")
    start = placed.groupBy("lang").agg(F.min(F.col("upto") - F.col("pairs")).alias("before"))
    band = F.ceil(F.log2((F.col("upto") - F.col("before")) / first_pairs))
    return settle(placed.join(start, "lang").select(
        F.col("id").alias("w1"), "lang", "f", F.greatest(F.lit(0), band).cast("int").alias("band")), "frontier")


def _phrase(names: list[str]) -> Column:
    return F.array(*[F.col(n) for n in names])


def _few(phrases: DataFrame) -> bool:
    return len(phrases.select(F.size("phrase")).head(SENT_ROWS + 1)) <= SENT_ROWS


def _met(windows: DataFrame, phrases: DataFrame, size: int, skip: int, small: bool) -> DataFrame:
    """Windows in which a phrase of that size stands after `skip` words, with the phrase's columns."""
    own = phrases.filter(F.size("phrase") == size)
    own = F.broadcast(own) if small else own
    for k in range(size):
        own = own.withColumn(f"p{k}", F.get("phrase", F.lit(k)))
    at = [F.col(f"p{k}") == F.col(_SLOTS[k + skip]) for k in range(size)]
    return windows.filter(F.col(_SLOTS[min(size + skip, LONGEST) - 1]) != 0).join(own, at)


def _grown(pairs: DataFrame, windows: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """All phrases of the nodes' first words: (phrase, a), with the node's columns."""
    two = pairs.select(_phrase(_SLOTS[:2]).alias("phrase"), "a")
    longer = windows.join(nodes.select("w1"), "w1", "left_semi").select("n", F.explode(F.array(*[
        F.when(F.col(_SLOTS[k - 1]) != 0, _phrase(_SLOTS[:k])) for k in range(3, LONGEST + 1)])).alias("phrase"))
    longer = longer.filter(F.col("phrase").isNotNull()).groupBy("phrase").agg(F.sum("n").alias("a")).filter(F.col("a") >= least)
    every = two.unionByName(longer).withColumn("w1", F.get("phrase", F.lit(0)))
    return every.join(nodes, "w1").select("phrase", "a", "lang", "n", "f", "floor")


def _bounded(grown: DataFrame, words: DataFrame) -> DataFrame:
    """Phrases whose bound, by the counts of their prefix and last word, reaches the threshold."""
    size = F.size("phrase")
    prefix = grown.select(F.col("phrase").alias("_prefix"), F.col("a").alias("_of_prefix"))
    last = words.select(F.col("id").alias("_last"), F.col("f").alias("_of_last"))
    both = grown.join(prefix, F.slice("phrase", F.lit(1), size - 1) == F.col("_prefix"), "left").join(
        last, F.element_at("phrase", -1) == F.col("_last"))
    bound = _floor_ratio(F.col("a"), F.col("n"), F.when(size == 2, F.col("f")).otherwise(F.col("_of_prefix")), F.col("_of_last"))
    return both.filter(F.col("floor").isNull() | (bound >= F.col("floor"))).select("phrase", "a", "lang", "n")


def _counts_of(need: DataFrame, words: DataFrame, pairs: DataFrame, windows: DataFrame) -> DataFrame:
    """(phrase, c): how often each phrase of `need`, all frequent, occurs."""
    one = need.filter(F.size("phrase") == 1).join(words, F.get("phrase", F.lit(0)) == F.col("id")).select("phrase", F.col("f").alias("c"))
    two = need.filter(F.size("phrase") == 2).join(
        pairs, (F.get("phrase", F.lit(0)) == F.col("w1")) & (F.get("phrase", F.lit(1)) == F.col("w2"))).select(
        "phrase", F.col("a").alias("c"))
    small = _few(need)
    more = [_met(windows, need, k, 0, small).groupBy("phrase").agg(F.sum("n").alias("c")) for k in range(3, LONGEST)]
    return reduce(DataFrame.unionByName, [one, two, *more])


def _contained(live: DataFrame, windows: DataFrame) -> DataFrame:
    """Phrases that a phrase one word longer, on either side, holds as often as they occur."""
    asked, found, small = live.select("phrase", "a"), [], _few(live)
    for size in range(2, LONGEST):
        before = _met(windows, asked, size, 1, small).groupBy("phrase", "a", F.col(_SLOTS[0]).alias("x"))
        after = _met(windows, asked, size, 0, small).filter(F.col(_SLOTS[size]) != 0).groupBy(
            "phrase", "a", F.col(_SLOTS[size]).alias("x"))
        found += [side.agg(F.sum("n").alias("c")).filter(F.col("c") == F.col("a")).select("phrase") for side in (before, after)]
    return reduce(DataFrame.union, found).distinct()


def _scored(live: DataFrame, words: DataFrame, pairs: DataFrame, windows: DataFrame) -> DataFrame:
    """Phrases that no longer one holds: (lang, phrase, a, l, r, n, score) of the cut that scores lowest."""
    size = F.size("phrase")
    cuts = live.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "lang", "phrase", "a", "n", "k", F.slice("phrase", F.lit(1), F.col("k")).alias("left"),
        F.slice("phrase", F.col("k") + 1, size).alias("right"))
    need = cuts.select(F.explode(F.array("left", "right")).alias("phrase")).distinct()
    counts = settle(_counts_of(settle(need, "phrase-parts"), words, pairs, windows), "part-counts")
    lefts = counts.select(F.col("phrase").alias("left"), F.col("c").alias("l"))
    rights = counts.select(F.col("phrase").alias("right"), F.col("c").alias("r"))
    value = _floor_ratio(F.col("a"), F.col("n"), F.col("l"), F.col("r"))
    best = cuts.join(lefts, "left").join(rights, "right").groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct(value.alias("score"), "k", "l", "r")).alias("cut"))
    kept = best.join(_contained(live, windows), "phrase", "left_anti")
    return kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def _spelled(scored: DataFrame, words: DataFrame) -> DataFrame:
    """Phrases as text."""
    each = scored.select("*", F.posexplode("phrase").alias("at", "id")).join(words.select("id", "word"), "id")
    facts = ["lang", "a", "l", "r", "n", "score"]
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ")
    return each.groupBy("phrase", *facts).agg(text.alias("_text")).select(*facts, F.col("_text").alias("phrase"))


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, text_col: str = "text", lang_col: str = "lang",
                 first_pairs: int | None = None) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best `top` phrases of each language (runs jobs).

    `first_pairs` is the size of the first band of first words, by the pairs that they begin.
    """
    langs, words, pairs, windows = phrase_counts(docs, least, text_col, lang_col)
    frontier = _frontier(words, pairs, first_pairs or 2 * top)
    bands = frontier.agg(F.max("band")).first()[0]
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    facts = ["lang", "phrase", "a", "l", "r", "n", "score"]
    best = docs.sparkSession.createDataFrame([], "lang string, phrase string, a long, l long, r long, n long, score long, rank long")
    for band in range(0 if bands is None else bands + 1):
        floors = best.filter(F.col("rank") == top).select(F.col("lang").alias("_lang"), F.col("score").alias("floor"))
        waiting = frontier.filter(F.col("band") >= band).join(langs, "lang").join(
            floors, F.col("lang") == F.col("_lang"), "left").drop("_lang")
        bound = _floor_ratio(F.lit(1), F.col("n"), F.col("f"), F.lit(1))
        reaching = settle(waiting.filter(F.col("floor").isNull() | (bound >= F.col("floor"))), "reaching-words")
        if reaching.isEmpty():
            break
        grown = settle(_grown(pairs, windows, reaching.filter(F.col("band") == band), least), "grown-phrases")
        live = settle(_bounded(grown, words), "live-phrases")
        found = _spelled(_scored(live, words, pairs, windows), words)
        ranked = best.select(*facts).unionByName(found.select(*facts)).withColumn("rank", F.row_number().over(order))
        best = settle(ranked.filter(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("long")), "best-phrases")
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
