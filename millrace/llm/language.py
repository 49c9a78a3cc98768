"""The language of a text by a small convolutional network over its bytes.

Filters of several widths slide over the bytes, the strongest response of each
in a window is kept, and a softmax layer reads those.  A text is cut into
windows of fixed length (all of it; a filter that starts in one window may end
in the next), and its answer is the mean over its windows, weighted by bytes.

The network is trained in numpy on labelled windows.  What it learns from is
bounded by parameters (texts for each language, windows for each text), what
it is applied to is not.  Trained filters become tables indexed by pairs of
bytes, so a response is a sum of look-ups.

Asked to, the network learns one class more: what is in no language.  Its rows
are made from the labelled ones (letters dealt anew, random letters, syllables
and scripts, dumps, repeated signs), of all lengths.  How sure it must be to
reject a text is set for each length on labelled pieces it did not learn from,
so that short clean texts, which look like much else, stay.

Texts that are null or hold no letter get ``und`` with score 0, rejected ones too.  So do all
texts when there is nothing to learn from.  Rows are judged one by one and a
null ``doc_id`` stays null.  A language is any non-null ``lang`` of a
training row.  Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import by_batch, raw, stored

WINDOW = 256
WIDTHS = (2, 3, 4)
_TAIL = 3  # bytes that the widest filter reads behind its first
NONE = "und"


@dataclass
class Net:
    """Filters as tables: ``first`` by the pair at a place (all widths),
    ``second`` by the pair two bytes on (width 3 ignores its second byte)."""

    languages: list[str]
    first: np.ndarray
    second: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray
    #: By binary digits of a text's bytes, the most probability of no language
    #: (then the last class) that it may have; None where that is not learned.
    limits: np.ndarray | None = None


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' windows with tails, whose text each is, and its bytes."""
    sizes = np.array([len(t) for t in texts])
    counts = np.maximum(1, -(-sizes // WINDOW))
    flat = np.zeros(int(counts.sum()) * WINDOW + len(texts) * 8, np.uint8)
    starts, at = [], 0
    for text, count in zip(texts, counts.tolist(), strict=True):
        flat[at : at + len(text)] = np.frombuffer(text, np.uint8)
        starts.append(at + WINDOW * np.arange(count))
        at += count * WINDOW + 8
    owner = np.repeat(np.arange(len(texts)), counts)
    starts = np.concatenate(starts)
    place = np.concatenate([WINDOW * np.arange(c) for c in counts.tolist()])
    return flat[starts[:, None] + np.arange(WINDOW + _TAIL)], owner, np.clip(sizes[owner] - place, 1, WINDOW)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], filters: int = 8, inner: int = 8, rounds: int = 6, seed: int = 7) -> Net:
    """Adam on the cross entropy; the same rows give the same network."""
    rng = np.random.default_rng(seed)
    place = {"bytes": rng.normal(0, 0.5, (256, inner)).astype(np.float32)}
    for w in WIDTHS:
        place[f"filter{w}"] = rng.normal(0, 1 / np.sqrt(w * inner), (w, inner, filters)).astype(np.float32)
    place["bias"] = np.zeros(filters * len(WIDTHS), np.float32)
    place["weights"] = rng.normal(0, 0.2, (filters * len(WIDTHS), len(languages))).astype(np.float32)
    place["offset"] = np.zeros(len(languages), np.float32)
    mean, spread, step = {k: np.zeros_like(v) for k, v in place.items()}, {k: np.zeros_like(v) for k, v in place.items()}, 0
    for _ in range(rounds):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), 128):
            rows = order[at : at + 128]
            x, y = windows[rows], labels[rows]
            n = len(rows)
            deep = place["bytes"][x]
            pooled, peaks = [], []
            for w in WIDTHS:
                out = sum(deep[:, j : j + WINDOW] @ place[f"filter{w}"][j] for j in range(w))
                peak = out.argmax(axis=1)
                peaks.append(peak)
                pooled.append(np.take_along_axis(out, peak[:, None, :], axis=1)[:, 0])
            before = np.concatenate(pooled, axis=1) + place["bias"]
            hidden = np.maximum(before, 0)
            error = _softmax(hidden @ place["weights"] + place["offset"])
            error[np.arange(n), y] -= 1
            error /= n
            slope = {"weights": hidden.T @ error, "offset": error.sum(axis=0), "bytes": np.zeros_like(place["bytes"])}
            back = (error @ place["weights"].T) * (before > 0)
            slope["bias"] = back.sum(axis=0)
            for i, w in enumerate(WIDTHS):
                part, peak = back[:, i * filters : (i + 1) * filters], peaks[i]
                kernel = place[f"filter{w}"]
                slope[f"filter{w}"] = np.zeros_like(kernel)
                for j in range(w):
                    letters = x[np.arange(n)[:, None], peak + j]
                    slope[f"filter{w}"][j] = np.einsum("nf,nfd->df", part, place["bytes"][letters])
                    np.add.at(slope["bytes"], letters, part[:, :, None] * kernel[j].T[None])
            step += 1
            for k, g in slope.items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                spread[k] = 0.999 * spread[k] + 0.001 * g * g
                place[k] -= 0.01 * (mean[k] / (1 - 0.9**step)) / (np.sqrt(spread[k] / (1 - 0.999**step)) + 1e-7)
    by_byte = {w: [place["bytes"] @ place[f"filter{w}"][j] for j in range(w)] for w in WIDTHS}
    one, two = np.divmod(np.arange(65536), 256)
    first = np.concatenate([by_byte[w][0][one] + by_byte[w][1][two] for w in WIDTHS], axis=1)
    second = np.concatenate([by_byte[3][2][one], by_byte[4][2][one] + by_byte[4][3][two]], axis=1)
    return Net(languages, first.astype(np.float32), second.astype(np.float32), place["bias"], place["weights"], place["offset"])


def judge(net: Net, windows: np.ndarray) -> np.ndarray:
    """Each window's probabilities."""
    out = []
    filters = net.first.shape[1] // len(WIDTHS)
    for at in range(0, len(windows), 64):
        x = windows[at : at + 64].astype(np.uint16)
        pairs = (x[:, :-1] << 8) | x[:, 1:]
        near = net.first.take(pairs[:, :WINDOW], axis=0)
        near[:, :, filters:] += net.second.take(pairs[:, 2 : WINDOW + 2], axis=0)
        hidden = np.maximum(near.max(axis=1) + net.bias, 0)
        out.append(_softmax(hidden @ net.weights + net.offset))
    return np.concatenate(out)


def sample(documents: DataFrame, learn: Column, per_language: int = 400, per_text: int = 6) -> list:
    """Bounded labelled windows: of each language the texts first by the hash
    of their ids, and of each text windows spread evenly over it.

    Rows are chosen, not ids: of an id with very many rows come as many texts
    as the bound leaves room for.  Rows equal in id, language and text count as
    one in the result.  Before a language's rows are ranked, all but about four
    times as many ids as are wanted are left out by the same hash, so few rows
    meet in the task of a frequent language.
    """
    usable = documents.select("doc_id", "lang", "text").where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    mark = F.xxhash64("text").alias("mark")
    # One row per language; the network has an output for each of them.
    ids = usable.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids"))
    ids = F.broadcast(stored(ids))
    place = (F.xxhash64("doc_id").cast("double") + float(1 << 63)) / float(1 << 64)
    near = usable.where(F.length("text") > 0).select("doc_id", "lang", mark).join(ids, "lang")
    near = near.where(place * F.col("ids") <= 4 * per_language)
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "mark")
    chosen = near.withColumn("place", F.row_number().over(first)).where(F.col("place") <= per_language)
    chosen = stored(chosen.select("doc_id", "lang", "mark").distinct())
    # At most per_language narrow rows for each output of the network.
    marked = usable.withColumn("mark", mark)
    kept = marked.join(F.broadcast(chosen), ["doc_id", "lang", "mark"], "left_semi")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        languages, out = batch.column(1).to_pylist(), ([], [], [])
        for language, doc_id, data in zip(languages, batch.column(0).to_pylist(), raw(batch.column(2)), strict=True):
            found = windows_of([data.lower()])[0]
            for i in np.unique(np.linspace(0, len(found) - 1, min(per_text, len(found))).astype(int)).tolist():
                for column, value in zip(out, (language, doc_id, found[i].tobytes()), strict=True):
                    column.append(value)
        kinds = (pa.string(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["lang", "doc_id", "window"])

    cut = by_batch(kept.select(F.col("doc_id").cast("long"), "lang", "text"), work, "lang string, doc_id long, window binary")
    # Equal rows give equal windows; one set of them is enough.
    return sorted((r["lang"], r["doc_id"], bytes(r["window"])) for r in cut.distinct().collect())


def learn_languages(documents: DataFrame, learn: Column, per_language: int = 400, per_text: int = 6, reject: bool = False) -> Net | None:
    """A network from the rows that ``learn`` is true for; None without any.

    With ``reject`` it also learns what is in no language.
    """
    rows = sample(documents, learn, per_language, per_text)
    if not rows:
        return None
    languages = sorted({lang for lang, _, _ in rows})
    labels = np.array([languages.index(lang) for lang, _, _ in rows])
    if reject:
        return _train_rejecting([w.rstrip(b"\0") for _, _, w in rows], labels, [doc_id for _, doc_id, _ in rows], languages)
    return train(np.stack([np.frombuffer(w, np.uint8) for _, _, w in rows]), labels, languages)


def no_language(rng: np.random.Generator, text: str) -> str:
    """Something of about this text's length that is in no language."""
    kind, n = int(rng.integers(6)), max(1, len(text))
    drawn = lambda signs, k: "".join(signs[i] for i in rng.integers(0, len(signs), k).tolist())
    if kind == 0:  # its own letters dealt anew; spaces stay
        signs = [c for c in text if not c.isspace()]
        dealt = iter(rng.permutation(len(signs)).tolist())
        return "".join(c if c.isspace() else signs[next(dealt)] for c in text)
    if kind == 1:  # dumps, in lines or not
        signs = ("0123456789abcdef", "abcdefghijklmnopqrstuvwxyz" * 2 + "0123456789+/", "abcdefghijklmnopqrstuvwxyz234567")[rng.integers(3)]
        width = int(rng.choice([64, 76, 10_000]))
        dump = drawn(signs, n)
        return "\n".join(dump[i : i + width] for i in range(0, n, width))
    if kind == 2:  # one or two signs again and again
        return (drawn("abcdefghijklmnopqrstuvwxyz", int(rng.integers(1, 3))) * n)[:n]
    if kind == 3:  # words of invented syllables
        signs = [drawn("bcdfghjklmnpqrstvwxyz", 1) + drawn("aeiouy", 1) + drawn(["", "", *"nrslkt"], 1) for _ in range(int(rng.integers(10, 60)))]
    elif kind == 4:  # another script
        start = int(np.exp(rng.uniform(np.log(0x100), np.log(0xD000))))
        signs = [c for c in map(chr, range(start, start + int(rng.integers(24, 1000)))) if c.isalpha()]
    if kind == 5 or len(signs) < 8:  # random letters
        signs = list("abcdefghijklmnopqrstuvwxyz")
    out, size = [], 0
    while size < n:
        out.append(drawn(signs, int(rng.integers(1, 5 if kind == 3 else 11))))
        size += len(out[-1]) + 1
    return " ".join(out)[:n]


def _train_rejecting(texts: list[bytes], labels: np.ndarray, ids: list, languages: list[str], share: float = 0.995, least: float = 0.9, seed: int = 7) -> Net:
    """A network whose last class is no language.  Of the texts, by a hash of
    their ids, one in seven is left out of the training and sets the limits: at
    each length ``share`` of its pieces stay within them; they are ``least`` at least."""
    rng = np.random.default_rng(seed)

    def piece(text: bytes) -> bytes:
        words = text.split()
        count = min(len(words), int(2 ** rng.uniform(0, 5)))
        at = int(rng.integers(0, len(words) - count + 1)) if words else 0
        return b" ".join(words[at : at + count]) or text

    def cut(text: bytes) -> np.ndarray:
        return np.frombuffer(text[: WINDOW + _TAIL].ljust(WINDOW + _TAIL, b"\0"), np.uint8)

    every = [x for text in texts for x in (text, piece(text))]
    kinds, size = np.repeat(labels, 2), np.array([max(1, min(len(x), WINDOW)) for x in every])
    held = np.repeat(np.array([zlib.crc32(str(i).encode()) % 7 for i in ids]) == 0, 2)
    if held.all() or not held.any():
        held = np.arange(len(every)) // 2 % 5 == 0
    if held.all():
        held = np.zeros(len(every), bool)
    kept = np.flatnonzero(~held)
    noise = [no_language(rng, every[i].decode("utf-8", "ignore")).lower().encode() for i in kept.tolist()]
    windows = np.stack([cut(every[i]) for i in kept.tolist()] + [cut(x) for x in noise])
    rounds = max(6, -(-300 * 128 // len(windows)))
    net = train(windows, np.concatenate([kinds[kept], np.full(len(noise), len(languages))]), [*languages, NONE], rounds=rounds, seed=seed)
    net.languages, net.limits = languages, np.full(WINDOW.bit_length() + 1, least)
    if held.any():
        chance = judge(net, np.stack([cut(every[i]) for i in np.flatnonzero(held).tolist()]))[:, -1]
        digits = np.array([int(x).bit_length() for x in size[held]])
        for k in range(len(net.limits)):
            some = chance[digits == k]
            if len(some):
                net.limits[k] = min(0.99, max(least, float(np.quantile(some, share))))
    return net


def languages_of(net: Net | None, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
    names, scores = [NONE] * len(texts), [0.0] * len(texts)
    fit = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t.decode("utf-8", "replace")))]
    if net is None:
        return names, scores
    group: list[int] = []
    size = 0

    def flush() -> None:
        windows, owner, weight = windows_of([texts[i].lower() for i in group])
        chance = judge(net, windows) * weight[:, None]
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        total = np.add.reduceat(chance, starts, axis=0) / np.add.reduceat(weight, starts)[:, None]
        stays = np.ones(len(group), bool)
        if net.limits is not None:
            digits = [min(len(texts[i]), WINDOW).bit_length() for i in group]
            stays, total = total[:, -1] <= net.limits[digits], total[:, :-1]
        for i, best, score, stay in zip(group, total.argmax(axis=1).tolist(), total.max(axis=1).tolist(), stays.tolist(), strict=True):
            if stay:
                names[i], scores[i] = net.languages[best], min(1.0, max(0.0, round(float(score), 6)))

    for i in fit:
        group.append(i)
        size += len(texts[i])
        if size > 1 << 21:
            flush()
            group, size = [], 0
    if group:
        flush()
    return names, scores


def with_language(documents: DataFrame, net: Net | None, least: float) -> DataFrame:
    """The documents, columns as they were, whose text has a language with at
    least this score; all with a letter where there was nothing to learn from."""
    shared = documents.sparkSession.sparkContext.broadcast(net)
    at = documents.columns.index("text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = raw(batch.column(at))
        names, scores = languages_of(shared.value, texts)
        if shared.value is None:
            keep = [bool(t) and any(map(str.isalpha, t.decode("utf-8", "replace"))) for t in texts]
        else:
            keep = [n != NONE and s >= least for n, s in zip(names, scores, strict=True)]
        return batch.filter(pa.array(keep, pa.bool_()))

    return by_batch(documents, work, documents.schema)


def identify(documents: DataFrame, net: Net | None) -> DataFrame:
    """``doc_id, lang_pred, score`` for every document's whole text."""
    shared = documents.sparkSession.sparkContext.broadcast(net)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, scores = languages_of(shared.value, raw(batch.column(1)))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(names), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return by_batch(rows, work, "doc_id long, lang_pred string, score double")
