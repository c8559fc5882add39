"""Language ID by multilingual mixture inference.

Training counts hashed byte trigrams and 4-grams of words per language over all
labelled rows.  A word's log-likelihood under a language is the sum of its
n-grams' smoothed log-probabilities.  For each text, expectation-maximisation
estimates the proportions of the languages; the set of languages grows from the
best single one as long as the next gains more log-likelihood than its penalty.
Proportions are renewed until they stand still.

A model of up to ``most_languages`` labels is one array that tasks hold.  With more
labels, ``predict`` works in groups of labels: a written table of counts stands for
the model, one group at a time is made an array, and each text carries the word
likelihoods of the languages chosen so far.  In each round every group offers its
best further language, the best offer is tried, and texts for which nothing gains
are done.  That is the same greedy choice over all labels; only its passes grow with
their number.

Null text and text without a letter give ``und`` with score 0.  Texts are read
whole, a slice at a time.  Equal likelihoods go to the language that sorts
first.  Repeated rows get equal results; an empty table, or one without labelled
rows, gives ``und`` rows.  Null labels are not learned; other columns are not
read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marblework.llm.common import cut, filter_rows, map_rows, pieces, release, ship, unused

UNKNOWN = "und"
BITS = 15
BUCKETS = 1 << BITS
#: Labels that a model learns at most, and the floats that a text's word likelihoods may take before they are computed slice by slice.
MOST_LANGUAGES, HELD_FLOATS = 256, 1 << 24
#: Log-likelihood that a further language must gain, besides the logarithm of the number of words.
PENALTY = 6.0
#: Rounds of expectation-maximisation at most, and the change of a proportion that ends them.
ROUNDS, STILL = 50, 1e-3
SLICE = 1 << 18
_LETTER = re.compile(r"[^\W\d_]")
#: Lower-cases A-Z, blanks all other ASCII but letters, keeps the bytes of other characters.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def slices(raw: bytes) -> Iterator[bytes]:
    """The text in pieces of about SLICE bytes that end at a word's end, blanks around each."""
    raw, at = b" " + raw.translate(_TABLE) + b"   ", 0
    while at < len(raw):
        end = raw.find(b" ", at + SLICE)
        end = len(raw) if end < 0 else end
        yield b" " + raw[at:end] + b"   "
        at = end


def ngrams(piece: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram buckets, 4-gram buckets (shifted by BUCKETS) at each letter, and where among them words start."""
    b = np.frombuffer(piece, np.uint8)
    at = np.flatnonzero(b[1:-3] != 32) + 1
    x = b.astype(np.uint32)
    tri = x[at - 1] | x[at] << np.uint32(8) | x[at + 1] << np.uint32(16)
    four = tri | x[at + 2] << np.uint32(24)
    move = np.uint32(32 - BITS)
    starts = np.flatnonzero(b[at - 1] == 32)
    return (tri * np.uint32(2654435761)) >> move, ((four * np.uint32(2246822519) + np.uint32(374761393)) >> move) + np.uint32(BUCKETS), starts


def held_out(id_column: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is kept from training: crc32 of its id as text."""
    return F.crc32(id_column.cast("string").cast("binary")) % folds == fold


def train(df: DataFrame, learn: Column, lang_column: str = "lang", text_column: str = "text", most_languages: int = MOST_LANGUAGES) -> dict:
    """{"langs": sorted names, "logp": array 2 BUCKETS x languages}, learned from all rows where ``learn`` holds.

    Tasks count locally; the sums of up to ``most_languages`` labels, at most
    2 BUCKETS rows each, reach the driver.  With more labels the result is
    {"counts": the sums as a written table, "groups": how many groups of labels}.
    """
    labelled = df.filter(learn & df[text_column].isNotNull() & df[lang_column].isNotNull()).select(df[lang_column].cast("string").alias("lang"), df[text_column].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[str, np.ndarray] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for lang, held in cells.items():
                at = np.flatnonzero(held)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(held[at])], names=["lang", "bucket", "n"])
            cells.clear()

        def add(lang: str, texts: list[str]) -> None:
            if lang not in cells:
                cells[lang] = np.zeros(2 * BUCKETS)
            held = cells[lang]
            for piece in slices("\n".join(texts).encode()):
                tri, four, _ = ngrams(piece)
                held += np.bincount(tri, minlength=2 * BUCKETS) + np.bincount(four, minlength=2 * BUCKETS)

        for batch in pieces(batches):
            by: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                if len(cells) >= most_languages and lang not in cells:
                    yield from sent()
                add(lang, texts)
        yield from sent()

    ship(df.sparkSession)
    sums = labelled.mapInArrow(run, "lang string, bucket int, n double").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    labels = df.filter(learn & df[lang_column].isNotNull()).select(df[lang_column].cast("string")).distinct().count()
    if labels > most_languages:
        return {"counts": cut(sums), "groups": -(-2 * labels // most_languages)}
    return _arrays(sums)


def _arrays(sums: DataFrame) -> dict:
    """The model of the languages of (lang, bucket, n)."""
    rows = sums.toPandas()
    langs = sorted(rows["lang"].unique())
    n = np.zeros((2 * BUCKETS, len(langs)))
    for i, lang in enumerate(langs):
        of = rows[rows["lang"] == lang]
        n[of["bucket"].to_numpy(np.int64), i] = of["n"].to_numpy()
    logp = [np.log((half + 0.5) / (half.sum(0) + 0.5 * BUCKETS)) for half in (n[:BUCKETS], n[BUCKETS:])]
    return {"langs": langs, "logp": np.concatenate(logp).astype(np.float32)}


def proportions(trial: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The languages' proportions after expectation-maximisation, and the words' log-likelihoods under them.

    ``trial`` has the words' log-likelihoods, words x languages; ``share`` the
    proportions of all but the last, which begins with a tenth.
    """
    peak = trial.max(1, keepdims=True)
    p = np.exp(trial - peak)
    weight = np.append(share * 0.9, 0.1)
    for _ in range(ROUNDS):
        resp = p * weight
        resp /= resp.sum(1, keepdims=True)
        before, weight = weight, resp.mean(0)
        if np.abs(weight - before).max() < STILL:
            break
    return weight, np.log(p @ weight) + peak[:, 0]


class Model:
    """Infers mixtures with a trained model."""

    def __init__(self, trained: dict):
        self.langs, self.logp = trained["langs"], trained["logp"]

    def _words(self, piece: bytes) -> np.ndarray:
        """Log-likelihoods of a slice's words, words x languages, the two orders' mean."""
        tri, four, starts = ngrams(piece)
        if not len(starts):
            return np.zeros((0, len(self.langs)), np.float32)
        return np.add.reduceat((self.logp[tri] + self.logp[four]) * np.float32(0.5), starts, axis=0)

    def infer(self, text: str) -> tuple[list[tuple[str, float]], float]:
        """Languages of the text with their proportions, largest first, and how much likelier they make an n-gram than chance, in nats.

        No language without a letter or where nothing was learned.  The word
        likelihoods of a very long text are not all held but computed anew for
        each language that is added.
        """
        if not self.langs or not _LETTER.search(text):
            return [], 0.0
        raw = text.encode()
        if len(raw) * len(self.langs) <= 4 * HELD_FLOATS:
            held = [self._words(p) for p in slices(raw)]
            likes = lambda: held
        else:
            likes = lambda: map(self._words, slices(raw))
        single, n = np.zeros(len(self.langs)), 0
        for like in likes():
            single += like.sum(0, dtype=np.float64)
            n += len(like)
        if not n:
            return [], 0.0
        chosen, share = [int(np.argmax(single))], np.ones(1)
        best = float(single[chosen[0]])
        fee = PENALTY + np.log(n + 1)
        of = np.concatenate([like[:, chosen] for like in likes()]).astype(np.float64)
        now = of[:, 0]
        while len(chosen) < len(self.langs):
            # no set with one language more can gain more than all words that prefer it
            gain, at = np.zeros(len(self.langs)), 0
            for like in likes():
                gain += np.maximum(like - now[at : at + len(like), None], 0).sum(0)
                at += len(like)
            gain[chosen] = 0
            new = int(np.argmax(gain))
            if gain[new] <= fee:
                break
            trial = np.concatenate([of, np.concatenate([like[:, new] for like in likes()])[:, None]], axis=1)
            weight, mixed = proportions(trial, share)
            if mixed.sum() - best <= fee:
                break
            chosen, share, now, best, of = [*chosen, new], weight, mixed, float(mixed.sum()), trial
        order = sorted(range(len(chosen)), key=lambda i: (-share[i], self.langs[chosen[i]]))
        letters = sum(len(ngrams(p)[0]) for p in slices(raw))
        return [(self.langs[chosen[i]], float(share[i])) for i in order], best / max(1, letters) + float(np.log(BUCKETS))

    def mixture(self, text: str) -> list[tuple[str, float]]:
        """Languages of the text with their proportions, largest first; empty without a letter."""
        return self.infer(text)[0]

    def is_language(self, text: str | None) -> bool:
        """Whether a text has a letter and its languages make it likelier than chance; any letter will do where nothing was learned."""
        if not text or not _LETTER.search(text):
            return False
        langs, gain = self.infer(text)
        return not self.langs or not langs or gain > 0


_HELD: dict[int, Model] = {}


def shared_model(df: DataFrame, trained: dict):
    """A function for tasks that gives the worker's model; it is bounded by MOST_LANGUAGES x 2 BUCKETS."""
    held = df.sparkSession.sparkContext.broadcast(trained)
    key = zlib.crc32(trained["logp"].tobytes(), zlib.crc32("\n".join(trained["langs"]).encode()))

    def model() -> Model:
        if key not in _HELD:
            _HELD.clear()
            _HELD[key] = Model(held.value)
        return _HELD[key]

    return model


def predict(df: DataFrame, trained: dict, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row: id, lang_pred, score (its proportion), langs (the chosen set)."""
    if "counts" in trained:
        rows = cut(df.select(df[id_column].alias("_id"), df[text_column].alias("_text"), F.monotonically_increasing_id().alias("_row")))
        found = _in_groups(rows, trained)
        top, share = F.get("langs", F.lit(0)), F.get("shares", F.lit(0))
        none = F.array().cast("array<string>")
        out = cut(rows.select("_id", "_row").join(found, "_row", "left").select(F.col("_id").alias(id_column), F.coalesce(top, F.lit(UNKNOWN)).alias("lang_pred"), F.when(share.isNull(), 0.0).otherwise(F.least(share, F.lit(1.0))).alias("score"), F.coalesce("langs", none).alias("langs")))
        release(rows, found)
        return out
    model = shared_model(df, trained)

    def row(text: str | None) -> list:
        got = model().mixture(text) if text else []
        return [got[0][0], min(1.0, got[0][1]), [x for x, _ in got]] if got else [UNKNOWN, 0.0, []]

    return map_rows(df, [id_column, text_column], "lang_pred string, score double, langs array<string>", row)


def keep_languages(df: DataFrame, trained: dict, text_column: str = "text") -> DataFrame:
    """All columns of the rows whose text ``Model.is_language``."""
    if "counts" in trained:
        number = unused(df, "_row")
        rows = cut(df.withColumn(number, F.monotonically_increasing_id()))
        found = _in_groups(rows.select(F.col(number).alias("_row"), F.col(text_column).alias("_text")), trained)
        good = found.filter("gain > 0 OR size(langs) = 0").select(F.col("_row").alias(number))
        return rows.join(good, number, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
    model = shared_model(df, trained)
    return filter_rows(df, text_column, lambda text: model().is_language(text))


_STATE = "_row long, _text string, langs array<string>, shares array<double>, best double, likes binary"
_OFFER = "_row long, lang string, gain double, words binary"


def _in_groups(rows: DataFrame, trained: dict) -> DataFrame:
    """(_row, langs, shares, gain), written, of the rows (_row, _text) with a letter; ``gain`` as ``Model.infer`` has it."""
    spark, counts = rows.sparkSession, trained["counts"]
    ship(spark)

    def offers(state: DataFrame) -> list[DataFrame]:
        """From each group of labels, the best further language of each text, with its words' likelihoods."""
        out = []
        for i in range(trained["groups"]):
            some = _arrays(counts.filter(F.pmod(F.xxhash64("lang"), F.lit(trained["groups"])) == i))
            if some["langs"]:
                model = shared_model(rows, some)

                def run(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
                    for batch in pieces(batches, 16):
                        made = [(row, *x) for row, *state in zip(*(c.to_pylist() for c in batch.columns), strict=True) if (x := _offer(model(), *state))]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True) if made else [[]] * 4, (pa.int64(), pa.string(), pa.float64(), pa.binary()), strict=True)], names=["_row", "lang", "gain", "words"])

                out.append(cut(state.mapInArrow(run, _OFFER)))
        return out

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 16):
            made = [(row, text, *_taken(*more)) for row, text, *more in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            kinds = (pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.float64()), pa.float64(), pa.binary(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True) if made else [[]] * 7, kinds, strict=True)], names=["_row", "_text", "langs", "shares", "best", "likes", "grown"])

    empty = lambda kind: F.array().cast(kind)
    state = cut(rows.filter(F.col("_text").rlike(r"[\p{L}\p{M}\p{N}\p{So}]")).select("_row", "_text", empty("array<string>").alias("langs"), empty("array<double>").alias("shares"), F.lit(0.0).alias("best"), F.lit(None).cast("binary").alias("likes")))
    done = []
    while not state.isEmpty():
        offered = offers(state)
        every = offered[0]
        for df in offered[1:]:
            every = every.unionByName(df)
        best = every.groupBy("_row").agg(F.min_by(F.struct("lang", "words"), F.struct(-F.col("gain"), "lang")).alias("x"))
        grown = cut(state.join(best.select("_row", "x.lang", "x.words"), "_row", "left").select("_row", "_text", "langs", "shares", "best", "likes", "lang", "words").mapInArrow(step, f"{_STATE}, grown boolean"))
        done.append(cut(grown.filter("NOT grown").select("_row", "_text", "langs", "shares", "best")))
        release(state, *offered)
        state = cut(grown.filter("grown").drop("grown"))
        release(grown)
    release(state)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 64):
            made = []
            for row, text, langs, shares, best in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not _LETTER.search(text):
                    continue
                order = sorted(range(len(langs)), key=lambda i: (-shares[i], langs[i]))
                letters = sum(len(ngrams(p)[0]) for p in slices(text.encode()))
                made.append((row, [langs[i] for i in order], [shares[i] for i in order], best / max(1, letters) + float(np.log(BUCKETS)) if langs else 0.0))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True) if made else [[]] * 4, (pa.int64(), pa.list_(pa.string()), pa.list_(pa.float64()), pa.float64()), strict=True)], names=["_row", "langs", "shares", "gain"])

    kind = "_row long, langs array<string>, shares array<double>, gain double"
    if not done:
        return cut(rows.sparkSession.createDataFrame([], kind))
    whole = done[0]
    for df in done[1:]:
        whole = whole.unionByName(df)
    out = cut(whole.mapInArrow(last, kind))
    release(*done)
    return out


def _offer(model: Model, text: str, langs: list[str], shares: list[float], best: float, likes: bytes | None) -> tuple[str, float, bytes] | None:
    """The language of this model that gains most beside those chosen, what it gains, and its words' log-likelihoods."""
    if not _LETTER.search(text):
        return None
    raw, gain, at = text.encode(), np.zeros(len(model.langs)), 0
    if langs:
        of = np.frombuffer(likes, np.float64).reshape(-1, len(langs))
        now = of[:, 0] if len(langs) == 1 else _mixed(of, np.array(shares))
        for piece in slices(raw):
            like = model._words(piece)
            gain += np.maximum(like - now[at : at + len(like), None], 0).sum(0)
            at += len(like)
        gain[[i for i, x in enumerate(model.langs) if x in langs]] = 0
    else:
        for piece in slices(raw):
            like = model._words(piece)
            gain += like.sum(0, dtype=np.float64)
            at += len(like)
    if not at:
        return None
    new = int(np.argmax(gain))
    words = np.concatenate([model._words(p)[:, new] for p in slices(raw)]).astype(np.float64)
    return model.langs[new], float(gain[new]), words.tobytes()


def _mixed(of: np.ndarray, share: np.ndarray) -> np.ndarray:
    peak = of.max(1, keepdims=True)
    return np.log(np.exp(of - peak) @ share) + peak[:, 0]


def _taken(langs: list[str], shares: list[float], best: float, likes: bytes | None, lang: str | None, words: bytes | None) -> tuple:
    """The state after an offer, and whether the set grew: the first language always, a further one if it gains more than its fee."""
    if lang is None:
        return langs, shares, best, likes, False
    new = np.frombuffer(words, np.float64)
    if not langs:
        return [lang], [1.0], float(new.sum()), words, True
    of = np.frombuffer(likes, np.float64).reshape(-1, len(langs))
    trial = np.concatenate([of, new[:, None]], axis=1)
    weight, mixed = proportions(trial, np.array(shares))
    if mixed.sum() - best <= PENALTY + np.log(len(new) + 1):
        return langs, shares, best, likes, False
    return [*langs, lang], weight.tolist(), float(mixed.sum()), trial.tobytes(), True
