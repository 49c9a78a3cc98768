"""Near-copies of earlier lines removed: an exact set-similarity join.

A line is the set of its words.  Two lines match when their sets' Jaccard
similarity reaches the threshold; a line goes when an earlier line (by
``doc_id``, then line number) matches it, whether that one stays or not.

Lines with equal sets are put together first; of each set only the first line
takes part in the join.  A set's words are ordered by rarity, and only the
prefix in which similar sets must share a word is indexed.  Candidates that
share a prefix word pass a length filter, a positional filter, and a bound on
the symmetric difference from 64 parity bits, then their words are compared.
Candidates come in two rounds.  In the first each set meets one earlier set
for each of its words, which settles the members of large families of copies;
sets without a match yet meet all earlier sets that share a word.

The order by rarity needs counts, not names: words are counted by hash in a
table of fixed size (a sketch over all lines, 2 ** 21 counters), so it can be
sent to all tasks.  Words that fall together only sort less well.

Lines of fewer than ``least_words`` different words stay, by default those
without a word; null texts have no lines.  A set so small that one word more or
less already is too far off matches equal sets only, and none of its words is
indexed.  Lines at the same place (rows that repeat, or share a
null ``doc_id``) are neither earlier nor later than each other, unless a column
of row keys is named: then documents that share a ``doc_id`` come in the order
of their keys, and the lines that go are named by key.  Other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Words, by_batch, firsts, gathered, lists, marked, marks_of, mix, portions, raw, sorted_within, stored, unused

_COUNTERS = 1 << 21
_SLICES = 256  # of that table; a row of them stays small where it is held several times over
_LINES = "doc_id long, line long, set long, size long, bits long, prefix array<long>"
_KEY = "row_key"


def _line_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and line of each word; the text and number of each line."""
    words = Words(texts)
    breaks = np.flatnonzero(words.data == 10)
    text = np.searchsorted(words.text_starts, breaks, "right") - 1
    number = np.arange(len(breaks)) - np.searchsorted(breaks, words.text_starts)[text]
    return words.hashes, np.searchsorted(breaks, words.starts), text, number


def word_counts(documents: DataFrame) -> np.ndarray:
    """Occurrences of words over all texts, counted by hash."""
    out = np.zeros(_COUNTERS, np.int64)
    width = _COUNTERS // _SLICES
    for row in counted_slices(documents).collect():
        out[row["slice"] * width : (row["slice"] + 1) * width] = _counts(bytes(row["counts"]))
    return out


def counted_slices(documents: DataFrame) -> DataFrame:
    """The slices of that table in which there are counts.

    Tasks count in tables of their own, whose slices are summed by number.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_COUNTERS, np.int64)
        for batch in batches:
            texts = raw(batch.column(0))
            # A count touches the whole table, so it is not done for each portion.
            for part in portions(texts, 1 << 22):
                places = [(Words(texts[part][some]).hashes & np.uint64(_COUNTERS - 1)).astype(np.uint32) for some in portions(texts[part])]
                total += np.bincount(np.concatenate(places), minlength=_COUNTERS)
        yield from given(enumerate(np.split(total, _SLICES)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}  # at most the whole table
        for batch in batches:
            for i, counts in zip(batch.column("slice").to_pylist(), batch.column("counts"), strict=True):
                sums[i] = sums.get(i, 0) + _counts(counts.as_buffer())
        yield from given(sums.items())

    def given(slices: Iterable[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for i, counts in slices:
            if counts.any():
                small = counts.astype(np.uint32 if counts.max() < 1 << 32 else np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([small.tobytes()], pa.binary())], ["slice", "counts"])

    schema = "slice int, counts binary"
    some = documents.select("text").where("text is not null").mapInArrow(count, schema)
    return some.repartition("slice").mapInArrow(add, schema)


def _counts(held: pa.Buffer | bytes) -> np.ndarray:
    """Counts of a slice; those of less than 2 ** 32 take four bytes each."""
    narrow = memoryview(held).nbytes == 4 * (_COUNTERS // _SLICES)
    return np.frombuffer(held, np.uint32 if narrow else np.int64).astype(np.int64)


def _sets(texts: list[bytes], counts: np.ndarray | None, least_words: int) -> tuple | None:
    """Words of each line's set in order of rarity, or of hashes, and the sets' figures."""
    hashes, line, text, number = _line_words(texts)
    if not len(hashes):
        return None
    order = sorted_within(line, hashes)
    hashes, line = hashes[order], line[order]
    keep = firsts(line, hashes)
    hashes, line = hashes[keep], line[keep]
    starts = firsts(line)
    sizes = np.diff(np.append(starts, len(line)))
    fit = sizes >= least_words
    inside = np.repeat(fit, sizes)
    hashes, line, sizes = hashes[inside], line[inside], sizes[fit]
    if not len(sizes):
        return None
    starts = np.cumsum(sizes) - sizes
    lines = line[starts]
    name = mix(np.add.reduceat(mix(hashes, 1), starts), 2).view(np.int64)
    if counts is not None:
        # Rarest first; words as rare as each other by their hashes.
        often = np.minimum(counts[(hashes & np.uint64(_COUNTERS - 1)).astype(np.int64)], (1 << 24) - 1)
        hashes = hashes[sorted_within(line, (often.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))]
    return hashes, starts, sizes, name, text[lines], number[lines]


def line_sets(documents: DataFrame, counts: np.ndarray, percent: int, least_words: int, key: str | None = None) -> DataFrame:
    """Every line that takes part, with its set and the set's prefix; with the
    document's key (as ``row_key``) where one is named."""
    schema = _LINES + (f", {_KEY} long" if key else "")
    shared = documents.sparkSession.sparkContext.broadcast(counts)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, texts, out = batch.column(0).to_numpy(zero_copy_only=False), raw(batch.column(1)), []
        nulls = np.array(batch.column(0).is_null())
        for some in portions(texts):
            found = _sets([t or b"" for t in texts[some]], shared.value, least_words)
            if found is None:
                continue
            hashes, starts, sizes, name, text, number = found
            bits = np.bitwise_xor.reduceat(np.uint64(1) << (hashes >> np.uint64(58)), starts)
            place = np.arange(len(hashes)) - np.repeat(starts, sizes)
            length = sizes - (percent * sizes + 99) // 100 + 1
            length[100 * sizes < percent * (sizes + 1)] = 0  # only equal sets are similar enough
            prefix = place < np.repeat(length, sizes)
            owner = np.repeat(np.arange(len(sizes)), sizes)[prefix]
            documents = pa.array(names[some][text], pa.int64(), mask=nulls[some][text])
            columns = [number, name, sizes, bits.view(np.int64)]
            words = lists(hashes[prefix], np.bincount(owner, minlength=len(sizes)))
            keys = [batch.column(2)[some].take(pa.array(text))] if key else []
            out.append(pa.RecordBatch.from_arrays([documents, *(pa.array(c, pa.int64()) for c in columns), words, *keys], [c.split()[0] for c in schema.split(", ")]))
        return pa.Table.from_batches(out).combine_chunks().to_batches()[0] if out else None

    keys = [F.col(key).cast("long").alias(_KEY)] if key else []
    return by_batch(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *keys), work, schema)


def _words_of(documents: DataFrame, least_words: int, texts_wanted: np.ndarray, sets_wanted: np.ndarray) -> DataFrame:
    """The words of wanted sets, from the documents where they come first."""
    sc = documents.sparkSession.sparkContext
    wanted = sc.broadcast((texts_wanted, sets_wanted))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        in_texts, in_sets = wanted.value
        rows = np.flatnonzero(in_texts[batch.column(0).to_numpy()])
        texts = raw(batch.column(1).take(pa.array(rows)))
        names, words = [], []
        for some in portions(texts):
            found = _sets([t or b"" for t in texts[some]], None, least_words)
            if found is None:
                continue
            hashes, starts, sizes, name, _, _ = found
            for i in np.flatnonzero(in_sets[name & (len(in_sets) - 1)]).tolist():
                names.append(int(name[i]))
                words.append(hashes[starts[i] : starts[i] + sizes[i]].tobytes())
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(words, pa.binary())], ["set", "words"])

    rows = documents.select(marked(F.col("doc_id").cast("long")).alias("mark"), "text").where("text is not null")
    return by_batch(rows, work, "set long, words binary").dropDuplicates(["set"])


def matching(pairs: DataFrame, words: DataFrame, percent: int) -> DataFrame:
    """The pairs (``set``, ``other``) whose words are similar enough."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for mine, theirs in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            a, b = np.frombuffer(mine, np.uint64), np.frombuffer(theirs, np.uint64)
            common = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * common >= percent * (len(a) + len(b) - common))
        keep = pa.array(keep, pa.bool_())
        return pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["set", "other"])

    mine = words.select("set", F.col("words").alias("mine"))
    theirs = words.select(F.col("set").alias("other"), F.col("words").alias("theirs"))
    both = pairs.join(mine, "set").join(theirs, "other").select("set", "other", "mine", "theirs")
    return by_batch(both, work, "set long, other long")


def _close(a: dict[str, Column], b: dict[str, Column], percent: int) -> Column:
    """Length filter and difference bound, exact in integers."""
    both = a["size"] + b["size"]
    need = F.floor((percent * both + 99 + percent) / (100 + percent))
    apart = F.bit_count(a["bits"].bitwiseXOR(b["bits"]))
    lengths = (100 * a["size"] >= percent * b["size"]) & (100 * b["size"] >= percent * a["size"])
    return lengths & (apart <= both - 2 * need)


def _candidates(rows: DataFrame, percent: int, most: int, by: list[str]) -> DataFrame:
    """Pairs of sets that share a word, ``set`` later than ``other`` in the order ``by``.

    Rows are sorted by word, then place, cut into ranges anywhere.  Groups of
    up to ``most`` rows are compared within themselves.  Larger ones, and the
    outermost of a range, which may go on in another, are handed back as rows
    (``word`` is then not null), each also paired with the first of its group.
    """
    columns = rows.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", other long"

    def close(t: dict[str, np.ndarray], later: np.ndarray, early: np.ndarray) -> np.ndarray:
        a, b = t["size"][later], t["size"][early]
        need = (percent * (a + b) + 99 + percent) // (100 + percent)
        reach = 1 + np.minimum(a - t["place"][later], b - t["place"][early]) - 1
        fit = (100 * a >= percent * b) & (100 * b >= percent * a) & (reach >= need)
        later, early, room = later[fit], early[fit], (a + b - 2 * need)[fit]
        fit[fit] = np.bitwise_count(t["bits"][later] ^ t["bits"][early]) <= room
        return fit

    def answer(table: pa.Table, open_word: int | None, last: bool) -> list[pa.Table]:
        """What some groups give; the last may go on elsewhere."""
        t = {c: table.column(c).to_numpy(zero_copy_only=False) for c in ("set", "word", "size", "place", "bits")}
        t["bits"] = t["bits"].view(np.uint64)
        n = len(t["word"])
        starts = firsts(t["word"])
        sizes = np.diff(np.append(starts, n))
        rank = np.arange(n) - np.repeat(starts, sizes)
        large = sizes > most
        large[t["word"][starts] == open_word] = True
        large[-1] |= last
        large = np.repeat(large, sizes)
        out = []
        later = np.flatnonzero(~large)
        for lag in range(1, int(sizes.max())):
            later = later[rank[later] >= lag]
            if not len(later):
                break
            early = later - lag
            fit = close(t, later, early)
            out.append((t["set"][later[fit]], t["set"][early[fit]]))
        # The members of large groups meet the first one.
        later = np.flatnonzero(large & (rank > 0))
        early = np.repeat(starts, sizes)[later]
        fit = close(t, later, early)
        out.append((t["set"][later[fit]], t["set"][early[fit]]))
        given = []
        for mine, other in out:
            if len(mine):
                nulls = {f.name: pa.nulls(len(mine), f.type) for f in table.schema}
                given.append(nulls | {"set": pa.array(mine), "other": pa.array(other)})
        if large.any():
            handed = table.filter(pa.array(large))
            given.append({c: handed.column(c) for c in columns} | {"other": pa.nulls(handed.num_rows, pa.int64())})
        kinds = pa.schema([(f.name, f.type) for f in table.schema] + [("other", pa.int64())])
        return [pa.table([x[c] for c in kinds.names], schema=kinds) for x in given]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, opened = None, None  # rows of the last group so far; a word whose group is or may be in parts
        first = True
        for table in gathered(batches):
            table = table if held is None else pa.concat_tables([held, table])
            words = table.column("word").to_numpy()
            if first:
                opened, first = int(words[0]), False
            cut = int(np.searchsorted(words, words[-1]))
            if table.num_rows - cut > most:
                opened_now, cut = int(words[-1]), table.num_rows  # too large to wait for its end
            else:
                opened_now = None
            if cut:
                for found in answer(table.slice(0, cut), opened, opened_now is not None):
                    yield from found.combine_chunks().to_batches()
            held = table.slice(cut) if cut < table.num_rows else None
            opened = opened_now if opened_now is not None else (opened if held is not None and int(words[-1]) == opened else None)
        if held is not None:
            for found in answer(held, opened, True):
                yield from found.combine_chunks().to_batches()

    order = ["word", *by, "set"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)


def later_matches(documents: DataFrame, percent: int = 85, least_words: int = 1, compared: int = 256, key: str | None = None) -> DataFrame:
    """``doc_id, line`` (numbered from 0) of the lines that go; ``key, line``
    where ``key`` names a column that is different in every row.

    ``compared`` is the size up to which a group of sets that share a word is
    compared at once; larger groups take further rounds, with the same result.
    Runs the jobs that count words, store the sets and settle the rounds; short
    ones, as the driver's memory grows with the stages of a job and their tasks.
    """
    by = ["doc_id", _KEY, "line"] if key else ["doc_id", "line"]
    lines = stored(line_sets(documents, word_counts(documents), percent, least_words, key))
    figures = [F.first(c).alias(c) for c in ("size", "bits", "prefix")]
    sets = lines.groupBy("set").agg(F.min(F.struct(*by)).alias("first"), *figures)
    sets = stored(sets.select("set", *(f"first.{c}" for c in by), "size", "bits", "prefix"))
    rows = sets.select("set", *by, "size", "bits", F.posexplode("prefix").alias("place", "word"))
    found = stored(_candidates(rows, percent, compared, by))
    pairs = stored(found.where("word is null").select("set", "other").distinct())
    large = found.where("word is not null").drop("other")

    # The words that comparisons need: of these sets, from where they come first.
    def fetched(pairs: DataFrame) -> DataFrame:
        used = pairs.select(F.explode(F.array("set", "other")).alias("set")).distinct()
        used = stored(used.join(sets.select("set", "doc_id"), "set"))
        marks = marks_of(used, marked(F.col("doc_id")), marked(F.col("set"), False))
        return stored(_words_of(documents, least_words, *marks))

    # One earlier set for each, then the others of those without a match yet.
    words = fetched(pairs)
    one = pairs.groupBy("set").agg(F.min("other").alias("other"))
    settled = stored(matching(one, words, percent).select("set").distinct())
    rest = stored(pairs.join(one, ["set", "other"], "left_anti").join(settled, "set", "left_anti"))
    settled = stored(settled.unionByName(matching(rest, words, percent).select("set")).distinct())

    # Sets of large groups without a match meet all earlier ones of the group.
    shared = [*by, "size", "bits", "place", "set", "word"]
    me, them = {c: F.col(f"my_{c}") for c in shared}, {c: F.col(c) for c in shared}
    mine = large.join(settled, "set", "left_anti").select(*(F.col(c).alias(f"my_{c}") for c in shared))
    earlier = F.struct(*(them[c] for c in by)) < F.struct(*(me[c] for c in by))
    need = F.floor((percent * (me["size"] + them["size"]) + 99 + percent) / (100 + percent))
    reach = F.least(me["size"] - me["place"], them["size"] - them["place"])
    near = large.join(mine, them["word"] == me["word"]).where(earlier & (reach >= need) & _close(them, me, percent))
    near = near.select(me["set"].alias("set"), them["set"].alias("other")).distinct().join(pairs, ["set", "other"], "left_anti")
    near = stored(near)
    if near.take(1):
        settled = stored(settled.unionByName(matching(near, fetched(near), percent).select("set")).distinct())

    gone = sets.select("set", F.struct(*by).alias("first")).join(settled.withColumn("matched", F.lit(True)), "set", "left")
    back = lines.select("set", *by).join(gone, "set")
    later = F.col("first") < F.struct(*by)
    back = back.where(F.col("matched") | later)
    return back.select(F.col(_KEY).alias(key), "line") if key else back.select("doc_id", "line").distinct()


def without(documents: DataFrame, lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents, their other columns untouched, less the given lines.

    A document of which nothing is left but white space stays, with that.
    """
    doc, lost = (unused(documents.columns, name) for name in ("__doc", "__gone"))
    gone = lines.groupBy(F.col(key).alias(doc)).agg(F.collect_set("line").alias(lost))
    both = documents.join(gone, documents[key].eqNullSafe(gone[doc]), "left")
    parts = F.split("text", "\n", -1)
    kept = F.filter(parts, lambda part, i: ~F.array_contains(lost, i.cast("long")))
    text = F.when(F.col(lost).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return both.select(*(text.alias(c) if c == "text" else documents[c] for c in documents.columns))


def similar(percent: int, a: set, b: set) -> bool:
    """The contract of a match, for tests."""
    return 100 * len(a & b) >= percent * len(a | b) and len(a | b) > 0
