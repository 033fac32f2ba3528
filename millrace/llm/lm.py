"""An interpolated modified Kneser-Ney model of a given order, counted in Spark, read through memory maps.

Counting. Tokens are hashed, counted by ranges of the hash and numbered by falling frequency; from there on a run is the numbers
of its tokens, so no task sends a dictionary. Each task emits its distinct runs of `order` tokens
with counts, packed by cell of a grid: row by the context, column by the
last token. A context of any frequency is spread over a line of cells, and the grid grows
with the text, so a cell holds a bounded number of runs. Each cell merges its runs and writes
them as sorted hashes with counts; it passes on what its runs say about their contexts, by
ranges of the context's hash, and about the runs without their first token: before how many of those
a different token stands. These numbers are the counts of the next lower order, which is merged in the same
way, down to pairs. What pairs say about tokens meets by ranges of the token's
hash and gives the table of tokens, sorted by hash as well.

A context of several tokens that is not stored, but is itself a run of the lower order, was seen once.

Scoring. Workers map the files, which lie in the shared folder, so memory holds only the
pages in use. The tokens of a slice of texts are looked up in sorted order.

A text's tokens are its words and one end; ends also stand before the first word, as many as a context has.
NULL counts as empty, which is the end alone. Counts, N and V come from all texts given for training;
with none, every probability is 1 over the open vocabulary of one. Rows are scored one by one, so ties and
repeats need no rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow import give_back, map_texts, slices
from millrace.llm.mapped import THIN, look_up, mapped_array, range_of, thinned, widened, write_array, write_places, write_thin
from millrace.llm.words import END, mix, token_hashes
from millrace.session import drop_folder, ship_package, spent_shuffles_deleted, work_folder
from millrace.sources.tables import settle

TASK_TOKENS = 2_000_000  # tokens whose runs a task combines before it passes them on
CELL_BYTES = 16 << 20  # text per cell of the grid, for each token of a context
SCORED_BYTES = 4 << 20  # text looked up at once
_U = np.uint64


TOKEN = np.dtype([("count", "<u8"), ("before", "<u8"), ("total", "<u8"), ("n1", "<u8"), ("n2", "<u8"), ("n3", "<u8")])
WORD = np.dtype([("count", "<u8")])
CONTEXT = np.dtype([("total", "<u8"), ("n1", "<u8"), ("n2", "<u8"), ("n3", "<u8")])
NUMBER = np.dtype([("level", "u1"), ("at", "<u4")])  # of a token: its level (1 or more), its place there within the file
LEVELS = 66
TO_TOKENS, TO_CONTEXTS, TO_RUNS = range(3)  # where a row of facts goes
_FACTS = "kind int, place long, tokens binary, ids binary, numbers binary, widths array<int>, " \
         "cell long, c1 long, c2 long, c3 long, c4 long, runs long"


@dataclass(frozen=True)
class KneserNey:
    """Where the arrays lie, and the figures of the whole training text."""

    folder: str
    order: int
    side: int  # of the grid of runs
    ranges: int  # of tokens and contexts
    tokens: int  # N
    vocabulary: int  # V
    pairs: int
    run_discounts: tuple[tuple[float, ...], ...]  # of pairs, of three tokens and so on, for counts 1, 2 and more
    token_discounts: tuple[float, ...]
    left_over: float  # share that unigrams pass on to unseen tokens


def _row_of(left: np.ndarray, side: int) -> np.ndarray:
    return (mix(left + _U(1)) % _U(side)).astype(np.int64)


def _column_of(right: np.ndarray, side: int) -> np.ndarray:
    return (mix(right + _U(2)) % _U(side)).astype(np.int64)


def run_hash(columns: list[np.ndarray]) -> np.ndarray:
    """Of runs of tokens, given as a column per place; of one token, itself."""
    out = columns[0]
    for c in columns[1:]:
        out = mix(mix(out) * _U(3) + c)
    return out


def _cell_of(columns: list[np.ndarray], side: int) -> np.ndarray:
    return _row_of(run_hash(columns[:-1]), side) * side + _column_of(columns[-1], side)


def _distinct_runs(columns: list[np.ndarray], counts: np.ndarray | None,
                   span: int | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct runs of tokens and their summed counts; with `span` the columns hold numbers below it, not hashes.

    A run is one number while sorted, of which its tokens are read back, so no column is kept beside it.
    """
    code, size, levels = np.zeros(1, _U), 1, []  # size: the numbers of all runs so far are below it
    for c in columns:
        every, at = (None, c) if span else np.unique(c, return_inverse=True)
        n, shorter = span or max(1, len(every)), None
        if size * n >= 1 << 63:  # else numbers stay below the square of the length
            shorter, code = np.unique(code, return_inverse=True)
            code, size = code.astype(_U, copy=False), len(shorter)
        code = code * _U(n) + at.astype(_U, copy=False)
        size *= n
        levels.append((every, n, shorter))
        del at
    if counts is None:
        code.sort()
    else:
        order = np.argsort(code)
        code, counts = code[order], counts[order]
        del order
    first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.empty(0, int)
    if counts is None:
        summed = np.diff(first, append=len(code))
    else:
        summed = np.add.reduceat(counts, first) if len(first) else counts
    code, out = code[first], []
    for every, n, shorter in reversed(levels):
        code, at = np.divmod(code, _U(n))
        out.append(at if every is None else every[at.astype(np.int64)])
        if shorter is not None:
            code = shorter[code.astype(np.int64)]
    return out[::-1], summed


def _ids(numbers: np.ndarray) -> np.ndarray:
    """What stands for tokens in hashes of runs; different for each number."""
    return mix(numbers.astype(_U) + _U(1))


def _numbers(folder: str, ranges: int, tokens: np.ndarray) -> np.ndarray:
    """The numbers, from 1, of sorted token hashes; 0 of those that were not in training."""
    place = range_of(tokens, ranges)
    found = look_up(folder, tokens, place, ("words", "<u8"), ("numbers", NUMBER))
    starts = mapped_array(folder, "starts", "<u8").reshape(ranges, LEVELS)
    return np.where(found["level"] > 0, starts[place, found["level"]] + found["at"], _U(0)).astype(_U)


def _packed(cell: np.ndarray, columns: list[np.ndarray], counts: np.ndarray) -> Iterator[tuple]:
    """Sorted runs per cell: (cell, its tokens once each, numbers and counts in few bytes, widths); tokens of 32 bits stand for themselves."""
    short = max(int(c.max(initial=0)) for c in columns) < 1 << 32
    order = np.argsort(cell.astype(np.uint16) if cell.max(initial=0) < 1 << 16 else cell, kind="stable")
    cell, counts = cell[order], counts[order]
    columns = [c[order] for c in columns]
    edges = np.flatnonzero(np.diff(cell, prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:]):
        here, known, width = [c[a:b].astype(_U, copy=False) for c in columns], b"", []
        if not short:
            tokens, at = np.unique(np.concatenate(here), return_inverse=True)
            here = at.reshape(len(columns), b - a).astype(_U)
            known, width = thinned([np.diff(tokens, prepend=_U(0))])
        data, widths = thinned([np.diff(here[0], prepend=_U(0)), *here[1:], counts[a:b]])
        yield int(cell[a]), known, data, [*width, *widths]


def _unpacked(frame: pd.DataFrame, order: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """The numbers of all tokens once each, the runs as places of these, and the counts."""
    size, at = sum(int.from_bytes(data[:8], "little") for data in frame["numbers"]), 0
    columns, counts = np.empty((order, size), _U), np.empty(size, _U)
    for known, data, widths in zip(frame["tokens"], frame["numbers"], frame["widths"]):
        tokens = np.cumsum(*widened(known, widths[:1]), dtype=_U) if len(known) else None
        step, *others, n = widened(data, widths if tokens is None else widths[1:])
        for out, c in zip(columns, (np.cumsum(step, dtype=_U), *others)):
            out[at:at + len(n)] = c if tokens is None else tokens[c.astype(np.int64)]
        counts[at:at + len(n)] = n
        at += len(n)
    if columns.max(initial=0) < 1 << 32:
        columns = columns.astype(np.uint32)
    known, columns = np.unique(columns, return_inverse=True)
    return known.astype(_U), list(columns.reshape(order, size).astype(np.uint32)), counts


def _back(tokens: np.ndarray, sizes: np.ndarray, end, order: int) -> list[np.ndarray]:
    """Per token of texts that follow each other: the tokens order - 1 to 0 places before it, `end` before a text."""
    place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    columns = []
    for k in range(order - 1, 0, -1):
        c = np.full(len(tokens), end, tokens.dtype)
        c[k:] = tokens[:-k]
        c[place < k] = end
        columns.append(c)
    return [*columns, tokens]


def _batches_of(texts: DataFrame, flush, schema: str) -> DataFrame:
    """What `flush` makes of the token hashes and sizes of some `TASK_TOKENS` at a time, which it lets go."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, part in slices(batch, batch.column(0), SCORED_BYTES):
                held.append(token_hashes(part.to_pylist()))
                size += len(held[-1][0])
                if size >= TASK_TOKENS:
                    yield flush(held)
                    size = 0
        if held:
            yield flush(held)
        del held
        give_back()

    return texts.mapInArrow(run, schema)


def _count_tokens(texts: DataFrame, ranges: int) -> DataFrame:
    names = ["place", "tokens", "ids", "numbers", "widths"]
    types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int32())]

    def flush(held: list[tuple]) -> pa.RecordBatch:
        tokens, counts = np.unique(np.concatenate([t for t, _ in held]), return_counts=True)
        held.clear()
        facts = np.zeros(len(tokens), WORD)
        facts["count"] = counts
        rows = [row[1:] for row in _facts(TO_TOKENS, tokens, facts, ranges)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return _batches_of(texts, flush, "place long, tokens binary, ids binary, numbers binary, widths array<int>")


def _merge_words(folder: str):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        """Write one range of the tokens with their places in their levels; a level is a power of two of counts, the highest first."""
        place = int(frame["place"].iloc[0])
        tokens, facts = _read_facts(frame, WORD)
        numbers = np.zeros(len(tokens), NUMBER)
        numbers["level"] = 64 - np.floor(np.log2(facts["count"])).astype(np.int64)
        order = np.argsort(numbers["level"], kind="stable")
        sizes = np.bincount(numbers["level"], minlength=LEVELS)
        numbers["at"][order] = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        write_array(folder, f"words-{place}", tokens)
        write_array(folder, f"numbers-{place}", numbers)
        give_back()
        return pd.DataFrame({"place": [place], "sizes": [sizes.tolist()]})

    return run


def _number_tokens(folder: str, texts: DataFrame, ranges: int) -> None:
    """Tokens are numbered by falling frequency, so their numbers are short where they stand often; 66 sums per file pass the driver."""
    words = settle(_count_tokens(texts, ranges).groupBy("place").applyInPandas(
        _merge_words(folder), "place long, sizes array<long>"), "word-ranges")
    sizes = np.zeros((ranges, LEVELS), np.int64)
    for place, of_levels in words.collect():
        sizes[place] = of_levels
    ends = np.cumsum(sizes.T).reshape(LEVELS, ranges).T
    write_array(folder, "starts", (ends - sizes + 1).astype("<u8"))
    _note(folder, "words", words.select("place"))


def _count_runs(texts: DataFrame, folder: str, side: int, ranges: int, order: int) -> DataFrame:
    names = ["place", "tokens", "numbers", "widths"]
    types = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32())]

    def flush(held: list[tuple]) -> pa.RecordBatch:
        """Runs of all texts held, sorted as places among their tokens and passed on as the tokens' numbers."""
        tokens, sizes = (np.concatenate(x) for x in zip(*held))
        held.clear()
        known, tokens = np.unique(tokens, return_inverse=True)
        numbers = _numbers(folder, ranges, known)
        rising = np.argsort(numbers)
        place = np.empty(len(known), np.uint32)
        place[rising] = np.arange(len(known))
        tokens, end, numbers = place[tokens], place[np.searchsorted(known, END)], numbers[rising]
        back = _back(tokens, sizes, end, order)
        del tokens, known
        columns, counts = _distinct_runs(back, None, len(numbers))
        del back
        ids = _ids(numbers)
        cell = _cell_of([ids[c] for c in columns], side)
        columns = [numbers[c] for c in columns]
        rows = list(_packed(cell, columns, counts))
        del columns, counts
        give_back()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return _batches_of(texts, flush, "place long, tokens binary, numbers binary, widths array<int>")


def _merge_cell(folder: str, side: int, ranges: int, k: int, order: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        """Write one cell's runs of k tokens; return what they say about contexts, shorter runs and tokens, packed."""
        cell = int(frame["place"].iloc[0])
        known, numbers, counts = _unpacked(frame, k)
        numbers, counts = _distinct_runs(numbers, counts, len(known))
        numbers = [c.astype(np.uint32) for c in numbers]
        ids = _ids(known)
        hashes = run_hash([ids[c] for c in numbers])
        by = np.argsort(hashes)
        write_array(folder, f"runs{k}-{cell}", hashes[by])
        write_thin(folder, f"counts{k}-{cell}", counts[by])
        del hashes, by
        contexts, at = np.unique(run_hash([ids[c] for c in numbers[:-1]]), return_inverse=True)
        after = np.zeros(len(contexts), TOKEN if k == 2 else CONTEXT)
        after["total"] = np.bincount(at, counts.astype(np.float64), len(contexts))
        for n, these in (("n1", counts == 1), ("n2", counts == 2), ("n3", counts >= 3)):
            after[n] = np.bincount(at[these], minlength=len(contexts))
        ends, at = np.unique(numbers[-1], return_inverse=True)
        ends = ids[ends]
        ending = np.zeros(len(ends), TOKEN)
        if k == order:
            ending["count"] = np.bincount(at, counts.astype(np.float64), len(ends))
        if k == 2:
            ending["before"] = np.bincount(at, minlength=len(ends))
            rows = _facts(TO_TOKENS, *_sum_facts(np.concatenate((contexts, ends)), np.concatenate((after, ending))), ranges)
        else:
            rows = _facts(TO_CONTEXTS, contexts, after, ranges)
            if k == order:
                rows += _facts(TO_TOKENS, *_sum_facts(ends, ending), ranges)
            del at, after
            shorter, before = _distinct_runs(numbers[1:], None, len(known))
            to = _cell_of([ids[c] for c in shorter], side)
            rows += [(TO_RUNS, place, tokens, None, data, widths)
                     for place, tokens, data, widths in _packed(to, [known[c] for c in shorter], before)]
        out = pd.DataFrame(rows, columns=["kind", "place", "tokens", "ids", "numbers", "widths"])
        out["cell"] = pd.array([cell] + [None] * (len(rows) - 1), "Int64")
        for n in (1, 2, 3, 4):
            out[f"c{n}"] = [int((counts == n).sum())] + [0] * (len(rows) - 1)
        out["runs"] = [len(counts)] + [0] * (len(rows) - 1)
        give_back()
        return out

    return run


def _facts(kind: int, keys: np.ndarray, facts: np.ndarray, ranges: int) -> list[tuple]:
    """Rows per range of sorted keys: the first key, the gaps between keys, the facts."""
    place = range_of(keys, ranges)
    edges = np.flatnonzero(np.diff(place, prepend=-1, append=ranges))
    rows = []
    for a, b in zip(edges[:-1], edges[1:]):
        gaps, width = thinned([np.diff(keys[a:b])])
        data, widths = thinned([facts[n][a:b] for n in facts.dtype.names])
        rows.append((kind, int(place[a]), keys[a:a + 1].tobytes(), gaps, data, [*width, *widths]))
    return rows


def _sum_facts(keys: np.ndarray, facts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, facts = keys[order], facts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, int)
    out = np.zeros(len(first), facts.dtype)
    for n in facts.dtype.names:
        out[n] = np.add.reduceat(facts[n], first) if len(first) else 0
    return keys[first], out


def _read_facts(frame: pd.DataFrame, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    keys, facts = [], []
    for first, gaps, data, widths in zip(frame["tokens"], frame["ids"], frame["numbers"], frame["widths"]):
        keys.append(np.cumsum(np.concatenate((np.frombuffer(first, "<u8"), *widened(gaps, widths[:1]))), dtype=np.uint64))
        part = np.zeros(len(keys[-1]), kind)
        for n, column in zip(kind.names, widened(data, widths[1:])):
            part[n] = column
        facts.append(part)
    return _sum_facts(np.concatenate(keys), np.concatenate(facts))


def _merge_contexts(folder: str, ranges: int, k: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        """Write one range of the contexts of k - 1 tokens that were seen more than once, or that only ends make."""
        place = int(frame["place"].iloc[0])
        contexts, facts = _read_facts(frame, CONTEXT)
        every_end = run_hash([_ids(_numbers(folder, ranges, np.array([END])))] * (k - 1))[0]
        stored = (facts["total"] > 1) | (contexts == every_end)
        write_array(folder, f"contexts{k}-{place}", contexts[stored])
        write_thin(folder, f"after{k}-{place}", facts[stored].view("<u8"))
        give_back()
        return pd.DataFrame({"place": [place]})

    return run


def _merge_tokens(folder: str):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        """Write one range of the token table; return its figures."""
        place = int(frame["place"].iloc[0])
        tokens, facts = _read_facts(frame, TOKEN)
        write_array(folder, f"tokens-{place}", tokens)
        write_thin(folder, f"facts-{place}", facts.view("<u8"))
        before = facts["before"]
        return pd.DataFrame([{"place": place, "n": int(facts["count"].sum()), "v": len(tokens),
                              **{f"b{k}": int((before == k).sum()) for k in (1, 2, 3, 4)},
                              "more": int((before >= 3).sum())}])

    return run


def _discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """For counts 1, 2 and more, from the numbers of counts 1 to 4; half a count where those tell nothing."""
    if not n1 or not n2:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2 - 3 * y * n3 / n2)
    return tuple(min(max(d, 0.05), k + 0.95) for k, d in enumerate(raw))


def _settle_facts(facts: DataFrame, k: int) -> tuple[DataFrame, str]:
    """Facts by kind, so that each kind can be deleted when it is merged; also the folder."""
    path = work_folder(facts.sparkSession, f"run-facts-{k}")
    facts.write.partitionBy("kind").parquet(path)
    return facts.sparkSession.read.schema(facts.schema).parquet(path), path


def _note(folder: str, name: str, places: DataFrame) -> None:
    """One number per file, of some 16 MB of text each, passes the driver."""
    write_places(folder, name, [row[0] for row in places.collect()])


def train(texts: DataFrame, text_col: str = "text", order: int = 2) -> KneserNey:
    """Count all rows of `texts`, in runs of up to `order` tokens (2 or more)."""
    if order < 2:
        raise ValueError("order is 2 or more")
    spark = texts.sparkSession
    ship_package(spark)
    folder = work_folder(spark, "language-model")
    rows = texts.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("_text") + 1), F.lit(0))).first()[0]
    side = max(2, int(np.ceil(np.sqrt(size * (order - 1) / CELL_BYTES))))
    ranges = max(2, side * side // 4)
    with spent_shuffles_deleted(spark):
        _number_tokens(folder, rows, ranges)
        packed, token_facts, discounts, spent = _count_runs(rows, folder, side, ranges, order), [], [], None
        for k in range(order, 1, -1):
            facts, kept = _settle_facts(packed.groupBy("place").applyInPandas(_merge_cell(folder, side, ranges, k, order), _FACTS), k)
            if spent:  # the runs that this order was merged from
                drop_folder(spark, spent)
            spent = f"{kept}/kind={TO_RUNS}"
            of_runs = facts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("c1", "c2", "c3", "c4", "runs")]).first()
            discounts.insert(0, _discounts(of_runs.c1, of_runs.c2, of_runs.c3, of_runs.c4))
            _note(folder, f"runs{k}", facts.filter("cell is not null").select("cell"))
            if k > 2:
                contexts = facts.filter(F.col("kind") == TO_CONTEXTS).select("place", "tokens", "ids", "numbers", "widths")
                _note(folder, f"contexts{k}", settle(
                    contexts.groupBy("place").applyInPandas(_merge_contexts(folder, ranges, k), "place long"), f"context-ranges-{k}"))
                drop_folder(spark, f"{kept}/kind={TO_CONTEXTS}")
            token_facts.append(spark.read.schema(facts.schema).parquet(kept).filter(F.col("kind") == TO_TOKENS)
                               .select("place", "tokens", "ids", "numbers", "widths"))
            packed = spark.read.schema(facts.schema).parquet(kept).filter(F.col("kind") == TO_RUNS).select("place", "tokens", "numbers", "widths")
        every = token_facts[0] if order == 2 else token_facts[0].unionByName(token_facts[-1])
        merged = settle(every.groupBy("place").applyInPandas(
            _merge_tokens(folder), "place long, n long, v long, b1 long, b2 long, b3 long, b4 long, more long"),
            "token-ranges")
    _note(folder, "tokens", merged.select("place"))
    t = merged.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in merged.columns if c != "place"]).first()
    token_discounts = _discounts(t.b1, t.b2, t.b3, t.b4)
    d1, d2, d3 = token_discounts
    left_over = (d1 * t.b1 + d2 * t.b2 + d3 * t.more) / of_runs.runs if of_runs.runs else 1.0
    return KneserNey(folder, order, side, ranges, t.n, t.v, of_runs.runs, tuple(discounts), token_discounts, left_over)


def _discounted(counts: np.ndarray, discounts: tuple[float, ...]) -> np.ndarray:
    return np.maximum(counts - np.array((0.0, *discounts))[np.minimum(counts, 3).astype(np.int64)], 0.0)


def _counts_of(model: KneserNey, columns: list[np.ndarray]) -> np.ndarray:
    """The stored counts of runs of tokens."""
    k, hashes, cells = len(columns), run_hash(columns), _cell_of(columns, model.side)
    order = np.argsort(hashes)
    found = np.zeros(len(hashes), "<u8")
    found[order] = look_up(model.folder, hashes[order], cells[order], (f"runs{k}", "<u8"), (f"counts{k}", THIN, 1))[:, 0]
    return found


def _after(model: KneserNey, columns: list[np.ndarray], stored: np.ndarray) -> np.ndarray:
    """What is known about contexts of two tokens or more; `stored`: which are runs of the lower order."""
    k, hashes = len(columns) + 1, run_hash(columns)
    hashes, at = np.unique(hashes, return_inverse=True)
    facts = look_up(model.folder, hashes, range_of(hashes, model.ranges), (f"contexts{k}", "<u8"),
                    (f"after{k}", THIN, len(CONTEXT.names))).view(CONTEXT)[:, 0][at]
    once = (facts["total"] == 0) & stored
    facts["total"][once] = facts["n1"][once] = 1
    return facts


def score_texts(model: KneserNey, texts: list[str]) -> list[list]:
    """Per text: tokens, known tokens, base score and score (log10)."""
    tokens, sizes = token_hashes(texts)
    known, at = np.unique(tokens, return_inverse=True)
    ids = _ids(_numbers(model.folder, model.ranges, known))
    rising = np.argsort(ids)
    facts = np.zeros(len(known), TOKEN)
    facts[rising] = look_up(model.folder, ids[rising], range_of(ids[rising], model.ranges), ("tokens", "<u8"),
                            ("facts", THIN, len(TOKEN.names))).view(TOKEN)[:, 0]
    count = facts["count"].astype(np.float64)
    base = np.log10((count + 0.5) / (model.tokens + 0.5 * (model.vocabulary + 1)))
    probability = np.full(len(known), model.left_over / (model.vocabulary + 1))
    if model.pairs:
        probability += _discounted(facts["before"], model.token_discounts) / model.pairs
    back = _back(at, sizes, np.searchsorted(known, END), model.order)
    run = at  # number of the run of k tokens that ends at each token
    for k, discounts in enumerate(model.run_discounts, 2):
        distinct, longer = np.unique(run * len(known) + back[-k], return_inverse=True)
        one = np.empty(len(distinct), np.int64)  # a place of each; any will do, and asking for the first sorts slower
        one[longer] = np.arange(len(longer))
        places = [c[one] for c in back[-k:]]
        columns = [ids[c] for c in places]
        # the context is the run that ended a token before; a text's first is ends alone, which is always known
        after = facts[places[0]] if k == 2 else _after(model, columns[:-1], found[run[one - 1]] > 0)
        found = _counts_of(model, columns)
        seen = after["total"] > 0
        total = np.where(seen, after["total"], 1.0)
        passed_on = sum(d * after[n] for d, n in zip(discounts, ("n1", "n2", "n3")))
        share = np.where(seen, passed_on / total, 1.0)
        probability = np.where(seen, _discounted(found, discounts) / total, 0.0) + share * probability[run[one]]
        run = longer
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    return [sizes.tolist(), np.add.reduceat((count > 0)[at].astype(np.int64), first).tolist(),
            np.add.reduceat(base[at], first).tolist(), np.add.reduceat(np.log10(probability)[run], first).tolist()]


def score(docs: DataFrame, model: KneserNey, keep: dict[str, str], text_col: str = "text") -> DataFrame:
    """The columns `keep` ({column: new name}) and n_tokens, n_known, base_score, score of every row."""
    made = {"n_tokens": (pa.int64(), "long"), "n_known": (pa.int64(), "long"),
            "base_score": (pa.float64(), "double"), "score": (pa.float64(), "double")}
    return map_texts(docs, text_col, keep, made, lambda: lambda texts: score_texts(model, texts), SCORED_BYTES)
