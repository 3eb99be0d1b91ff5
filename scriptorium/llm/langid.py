"""Operator 4: language identification by a byte convolutional network.

The whole UTF-8 text is cut into windows of WINDOW bytes (the last one padded with zeros). Filters of widths 2, 3 and 4
run over each window, the largest response of each filter goes through a rectifier into a softmax layer, and a text's
score for a language is the mean of its windows' probabilities, weighted by their bytes. The network is trained in numpy
on the driver, on a sample of labelled texts: about FIT_ROWS distinct ones a language, FIT_WINDOWS windows of each, spread
over the whole text. Prediction runs on Arrow batches; a filter's response is the sum of two table rows, looked up by byte
pairs.

Only the text is an input of a prediction. Defined results: a null text, or one without a letter, is ``und`` with score
0; a row without a label or text takes no part in training; without any labelled row all texts are ``und``; equal scores
go to the language first in code-point order; repeated rows get equal results; an empty table gives no rows; an output
column that the input has already is replaced by ``detect_language``; a text of any length is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, table, text_bytes, trim

WINDOW = 128
FILTERS = 12
FIT_ROWS, FIT_WINDOWS, FIT_STEPS, FIT_BATCH, MAX_LANGS = 400, 6, 260, 192, 1024
WIDTHS = (2, 3, 4)
RIDGE = 1e-4
UNDETERMINED = "und"


def windows(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows as rows of bytes, the text of each, bytes in each); a text has at least one."""
    n = np.maximum(1, -(-lens // WINDOW))
    owner = np.repeat(np.arange(len(lens)), n)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    begin = starts[owner] + step * WINDOW
    size = np.clip(lens[owner] - step * WINDOW, 0, WINDOW)
    padded = np.concatenate([data[: int((begin + size).max(initial=0))], np.zeros(WINDOW, np.uint8)])
    x = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[np.where(size > 0, begin, 0)]
    x[np.arange(WINDOW) >= size[:, None]] = 0
    return x, owner, size


class ByteNet:
    """tables[w][k]: 256 x FILTERS, what byte k of a window of width w adds to each filter."""

    def __init__(self, langs: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.tables = [[rng.normal(0, 0.3, (256, FILTERS)).astype(np.float32) for _ in range(w)] for w in WIDTHS]
        for w in self.tables:
            for t in w:
                t[0] = 0
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(langs))).astype(np.float32)
        self.bias = np.zeros(len(langs), np.float32)
        self.pairs = None

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Tables by byte pair: what bytes 0 and 1 of a filter add, and what bytes 2 and 3 add."""
        first, second = [], []
        for w in self.tables:
            first.append((w[0][:, None] + w[1][None]).reshape(1 << 16, FILTERS))
            zero = np.zeros((256, FILTERS), np.float32)
            second.append(((w[2] if len(w) > 2 else zero)[:, None] + (w[3] if len(w) > 3 else zero)[None]).reshape(1 << 16, FILTERS))
        return np.concatenate(first, 1), np.concatenate(second, 1)

    def responses(self, x: np.ndarray):
        """Filter responses at each place, one place at a time."""
        a, b = self.pairs if self.pairs is not None else self._pairs()
        wide = np.zeros((len(x), WINDOW + 3), np.uint16)
        wide[:, :WINDOW] = x
        pair = np.ascontiguousarray((wide[:, :-1] << 8 | wide[:, 1:]).T)
        for p in range(WINDOW - 1):
            yield a[pair[p]] + b[pair[p + 2]]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        pooled = np.full((len(x), len(WIDTHS) * FILTERS), -np.inf, np.float32)
        for r in self.responses(x):
            np.maximum(pooled, r, out=pooled)
        z = np.maximum(pooled, 0) @ self.out + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy (and a slight ridge on the last layer), for each table, then out, then bias."""
        padded = np.concatenate([x, np.zeros((len(x), 4), np.uint8)], 1)
        every = np.concatenate([sum(t[padded[:, k : k + WINDOW - 1]] for k, t in enumerate(w)) for w in self.tables], 2)
        at = every.argmax(axis=1)
        pooled = np.take_along_axis(every, at[:, None], 1)[:, 0]
        hidden = np.maximum(pooled, 0)
        z = hidden @ self.out + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        d = z / z.sum(axis=1, keepdims=True)
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        back = (d @ self.out.T) * (pooled > 0)
        grads = []
        rows = np.arange(len(x))[:, None]
        for i, w in enumerate(self.tables):
            cols = slice(i * FILTERS, (i + 1) * FILTERS)
            for k in range(len(w)):
                cell = padded[rows, at[:, cols] + k].astype(np.int64) * FILTERS + np.arange(FILTERS)
                grads.append(np.bincount(cell.ravel(), back[:, cols].ravel(), 256 * FILTERS).reshape(256, FILTERS).astype(np.float32))
                grads[-1][0] = 0  # padding adds nothing
        return [*grads, hidden.T @ d + RIDGE * self.out, d.sum(axis=0)]

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = FIT_STEPS, batch: int = FIT_BATCH, rate: float = 0.02, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        params = [*(t for w in self.tables for t in w), self.out, self.bias]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        by_class = [np.flatnonzero(y == c) for c in range(len(self.langs))]
        for step in range(1, steps + 1):
            pick = np.concatenate([rng.choice(own, max(1, batch // len(by_class))) for own in by_class if len(own)])
            for p, g, mm, vv in zip(params, self.gradients(x[pick], y[pick]), m, v):
                mm *= 0.9
                mm += 0.1 * g
                vv *= 0.99
                vv += 0.01 * g * g
                p -= rate * (1 - 0.7 * step / steps) * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.99**step)) + 1e-6)

    def predict(self, col: pa.Array, slice_bytes: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language, its probability) of each text, whole."""
        if self.pairs is None:
            self.pairs = self._pairs()
        data, starts, lens = text_bytes(col)
        total = np.zeros((len(lens), len(self.langs)))
        weight = np.zeros(len(lens))
        # a unit is at most slice_bytes of one text; long texts have several, so memory is bounded by the slice
        parts = np.maximum(1, -(-lens // slice_bytes))
        owner = np.repeat(np.arange(len(lens)), parts)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin, size = starts[owner] + step * slice_bytes, np.clip(lens[owner] - step * slice_bytes, 0, slice_bytes)
        ends, at = np.cumsum(size), 0
        while at < len(owner):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + slice_bytes, "right")))
            lo = int(begin[at:to].min())
            x, unit, n = windows(data[lo:], begin[at:to] - lo, size[at:to])
            p = self.probabilities(x) * n[:, None]
            np.add.at(total, owner[at:to][unit], p)
            np.add.at(weight, owner[at:to][unit], n)
            at = to
        score = total / np.maximum(weight, 1)[:, None]
        best = score.argmax(axis=1)
        return best, np.clip(score[np.arange(len(best)), best], 0, 1)


def fit_languages(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", rows: int = FIT_ROWS, max_langs: int = MAX_LANGS) -> ByteNet | None:
    """A network fitted on about ``rows`` distinct texts of each language; None if no row has a label and a letter.

    The sample is the texts with the smallest hashes, up to a limit that is set for each language from the number of its
    distinct texts, and its smallest hash at least, so every label has a text. A text gives up to FIT_WINDOWS windows,
    spread over all of it. The driver holds some 0.3 MB for each language, so more than max_langs labels raise ValueError:
    none is left out, and a column of so many values holds something else.
    """
    h = F.xxhash64("t", F.lit("fit")).bitwiseAND(F.lit((1 << 63) - 1))
    own = labelled.select(F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l")).filter("l is not null and t rlike '\\\\p{L}'").withColumn("h", h)
    counts = own.select("l", "h").distinct().groupBy("l").agg(F.count("*").alias("n"), F.min("h").alias("least")).limit(max_langs + 1).collect()
    if not counts:
        return None
    if len(counts) > max_langs:
        raise ValueError(f"more than {max_langs} labels")
    limits = [(r["l"], (1 << 63) - 1 if r["n"] <= rows else max(r["least"], (rows << 63) // r["n"])) for r in counts]
    limits = labelled.sparkSession.createDataFrame(limits, "l string, upto long")
    picked = own.join(F.broadcast(limits), "l").filter("h <= upto")
    # a long text is sent as FIT_WINDOWS pieces of a window each
    last = f"(char_length(t) - {WINDOW})"
    pieces = F.expr(f"transform(sequence(0, {FIT_WINDOWS - 1}), i -> substring(t, cast(1 + i * {last} div {FIT_WINDOWS - 1} as int), {WINDOW}))")
    long = F.char_length("t") > FIT_WINDOWS * WINDOW
    picked = picked.select("l", long.alias("long"), F.explode(F.when(long, pieces).otherwise(F.array("t"))).alias("t"))
    sample = sorted((r["l"], r["t"], r["long"]) for r in picked.distinct().toLocalIterator())
    langs = sorted({x for x, _, _ in sample})
    data, starts, lens = text_bytes(pa.array([t for _, t, _ in sample]))
    x, owner, size = windows(data, starts, lens)
    step = np.arange(len(owner)) - np.searchsorted(owner, owner)
    n = np.bincount(owner)[owner]
    most = np.where(np.array([w for _, _, w in sample])[owner], 1, np.minimum(n, FIT_WINDOWS))
    spread = step * most // n != (step - 1) * most // n  # the first window of each of `most` equal parts
    keep = spread & ((size >= 24) | (step == 0))
    place = {l: i for i, l in enumerate(langs)}
    y = np.array([place[sample[i][0]] for i in owner[keep]])
    net = ByteNet(langs)
    net.fit(x[keep], y)
    return net


def language(text: Column, net: ByteNet | None) -> Column:
    """struct<lang_pred string, score double> of a text column."""
    no_letter = F.named_struct(F.lit("lang_pred"), F.lit(UNDETERMINED), F.lit("score"), F.lit(0.0))
    if net is None:
        return no_letter

    @F.arrow_udf("struct<lang_pred string, score double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in batches:
            best, score = net.predict(col)
            names = pa.DictionaryArray.from_arrays(pa.array(best, pa.int32()), pa.array(net.langs, pa.string())).cast(pa.string())
            yield pa.StructArray.from_arrays([names, pa.array(score, pa.float64())], ["lang_pred", "score"])
        trim()

    return F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), predict(text)).otherwise(no_letter)


def detect_language(docs: DataFrame, net: ByteNet | None, *, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """docs with the predicted language and its score."""
    struct = fresh(docs.columns, "language_struct")
    out = docs.withColumn(struct, language(F.col(text_col), net))
    return out.withColumns({pred_col: F.col(f"{struct}.lang_pred"), score_col: F.col(f"{struct}.score")}).drop(struct)


def _remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder(F.col("doc_id")) == 1, F.lit(False))
    net = fit_languages(docs.filter(~held_out))
    out = detect_language(docs.select("doc_id", "text"), net)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


#: The pipeline drops texts without letters and texts whose best language has less than this share.
MIN_SCORE = 0.35


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose best language has a score of MIN_SCORE at least. Null texts and texts without a letter go; null ids and
    labels stay, a row without a label only teaches nothing; without any labelled row all go. Repeated rows fare alike; all
    columns of docs, whatever their names, come back as they are; an empty table gives no rows; texts are read whole."""
    net = fit_languages(docs.filter(F.coalesce(_remainder(F.col("doc_id")) != 1, F.lit(True))))
    pred, score = fresh(docs.columns, "lang_pred"), fresh(docs.columns, "lang_score")
    out = detect_language(docs, net, pred_col=pred, score_col=score)
    return out.filter((F.col(pred) != UNDETERMINED) & (F.col(score) >= MIN_SCORE)).select(*(F.col(f"`{c}`") for c in docs.columns))
