"""Problem 1: the language of documents and of the segments of mixed ones, with confidence.

Method: nearest-centroid classification.  A segment becomes a normalised TF-IDF
vector of hashed character n-grams (within words, ends marked).  Every language has
several centroids, found by spherical k-means over samples of known language.  The
nearest centroid by cosine gives the language; a segment is rejected when it is
farther from its nearest centroid than the samples of that language ever are, or
when no language is clearly nearest.

Everything is scored in NumPy over whole Arrow batches: n-grams are hashed once per
distinct word, a segment is the sum of its words, and one matrix product compares a
block of segments with all centroids.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.canonical import canonical_text

DIMS = 4096
GRAMS = (2, 3, 4)
BLOCK = 4096

# How languages are declared (codes of two and three letters, English
# names, own names).  Regions and scripts after "-" or "_" are cut off first.
LANGUAGE_NAMES = {
    "en": "en eng english anglais englisch inglés inglese engels inglês",
    "de": "de deu ger german deutsch allemand alemán tedesco duits alemão",
    "fr": "fr fra fre french français francais französisch francés francese frans francês",
    "es": "es spa spanish español espanol castellano spanisch espagnol spagnolo spaans espanhol",
    "it": "it ita italian italiano italienisch italien italiaans",
    "nl": "nl nld dut dutch nederlands niederländisch néerlandais neerlandés olandese holandés neerlandês",
    "pt": "pt por portuguese português portugues portugiesisch portugais portugués portoghese portugees",
}


def declared_language(col: Column) -> Column:
    """The two-letter code of a declared language in any usual spelling, else null; pure JVM."""
    pairs = [F.lit(x) for code, names in LANGUAGE_NAMES.items() for name in names.split() for x in (name, code)]
    known = F.create_map(*pairs)
    said = F.lower(F.regexp_replace(col, r"(?U)^\s+|\s+$", ""))
    return F.coalesce(F.try_element_at(known, said), F.try_element_at(known, F.regexp_extract(said, r"^([^-_ (]+)", 1)))


_ASIDE = re.compile(r"\"[^\"]{1,80}\"|“[^”]{1,80}”|«[^»]{1,80}»|\([^()]{1,80}\)")
_TOKEN = re.compile(r"[^\W_]+(?:[-–]\d[\w-]*)?")
_OPENERS = frozenset('"“«(')
# A single line end inside a sentence is only a wrapped line.
_SENTENCE = re.compile(r"(?<=[.!?;:…|])[\"”»)]*\s+|\n\s*\n\s*|\n(?=[-*•\d])|\t+")
_PART = re.compile(r"\s+[|/•·–—-]+\s+|[;\n\t]+\s*|(?<=[.!?])\s+")


def segment_spans(text: str, part: bool) -> list[tuple[int, int]]:
    """Offsets of the sentences of a text, or of the parts of a label (``part``)."""
    spans, at = [], 0
    for m in (_PART if part else _SENTENCE).finditer(text):
        if m.start() > at:
            spans.append((at, m.start()))
        at = m.end()
    if at < len(text):
        spans.append((at, len(text)))
    return spans


def words_of(segment: str) -> list[str]:
    """The words of a segment that can tell a language: no codes, figures or quoted asides."""
    if not _OPENERS.isdisjoint(segment):
        segment = _ASIDE.sub(" ", segment)
    return [t for t in _TOKEN.findall(segment.lower()) if t.isalpha()]


def grams_of(word: str) -> list[int]:
    """Hashed features of a word: its n-grams with marked ends, and the word itself."""
    x = f"<{word}>"
    return [zlib.crc32(x[k : k + n].encode()) % DIMS for n in GRAMS for k in range(len(x) - n + 1)] + [zlib.crc32(f"={word}".encode()) % DIMS]


class Pool:
    """Rows of changing length kept end to end, so that many can be gathered at once."""

    def __init__(self, dtype) -> None:
        self.data, self.used = np.zeros(1024, dtype), 0
        self.starts, self.sizes = [], []

    def add(self, row: list) -> None:
        while self.used + len(row) > self.data.size:
            self.data = np.concatenate([self.data, np.zeros_like(self.data)])
        self.data[self.used : self.used + len(row)] = row
        self.starts.append(self.used)
        self.sizes.append(len(row))
        self.used += len(row)

    def take(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows ``ids`` end to end, and their sizes."""
        sizes = np.asarray(self.sizes, np.int64)[ids]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(np.asarray(self.starts, np.int64)[ids] - ends + sizes, sizes)
        return self.data[at], sizes


def dense_counts(segments: list[list[str]]) -> np.ndarray:
    """Term frequencies, one row per segment; for fitting."""
    out = np.zeros((len(segments), DIMS), np.float32)
    seen: dict[str, list[int]] = {}
    for i, ws in enumerate(segments):
        for w in ws:
            if w not in seen:
                seen[w] = grams_of(w)
        out[i] = np.bincount([g for w in ws for g in seen[w]], minlength=DIMS)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    return x / np.where(n > 0, n, 1)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Centroids (unit) and each row's centroid; farthest-first start, so no chance is involved."""
    k = min(k, len(x))
    centers = [_unit(x.mean(0, keepdims=True))[0]]
    near = x @ centers[0]
    centers[0] = x[int(near.argmax())]
    near = x @ centers[0]
    while len(centers) < k:
        centers.append(x[int(near.argmin())])
        near = np.maximum(near, x @ centers[-1])
    c = np.stack(centers)
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        c = np.stack([_unit(x[own == j].sum(0, keepdims=True))[0] if (own == j).any() else c[j] for j in range(len(c))])
    return c, (x @ c.T).argmax(1)


@dataclass
class LanguageModel:
    """``names`` of the languages, the ``owner`` language of each of the ``centroids``, the ``idf`` and each centroid's least cosine.

    ``min_gap`` is how much nearer a language must be than any other where nothing
    else speaks for it; ``own_gap`` is what suffices for the language that most of
    the same text has.
    """

    names: list[str]
    owner: np.ndarray
    centroids: np.ndarray
    idf: np.ndarray
    least: np.ndarray
    min_gap: float = 0.05
    own_gap: float = 0.005
    min_words: int = 3

    LIMIT = 200_000

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def _clear(self) -> None:
        self._ids, self._grams, self._dots = {}, Pool(np.int32), np.zeros((1024, len(self.owner)), np.float32)

    def _lookup(self, words: list[str]) -> list[int]:
        ids, out = self._ids, []
        for w in words:
            i = ids.get(w)
            if i is None:
                g = grams_of(w)
                i = ids[w] = len(ids)
                self._grams.add(g)
                if i >= len(self._dots):
                    self._dots = np.concatenate([self._dots, np.zeros_like(self._dots)])
                self._dots[i] = self.centroids[:, g] @ self.idf[g]
            out.append(i)
        return out

    def cosines(self, segments: list[list[str]]) -> np.ndarray:
        """Cosine of every segment with every centroid.

        The product with a centroid is the sum over the words, which are kept per
        distinct word; the norm needs the n-gram counts of the whole segment, found
        by sorting (segment, n-gram) keys.
        """
        if not hasattr(self, "_ids") or len(self._ids) > self.LIMIT:
            self._clear()
        out = np.zeros((len(segments), len(self.owner)), np.float32)
        full = [i for i, ws in enumerate(segments) if ws]
        if not full:
            return out
        rows = [self._lookup(segments[i]) for i in full]
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        ids = np.fromiter((i for r in rows for i in r), np.int64, int(lengths.sum()))
        dots = np.add.reduceat(self._dots[ids], np.cumsum(lengths) - lengths)
        grams, sizes = self._grams.take(ids)
        keys = np.repeat(np.repeat(np.arange(len(rows), dtype=np.int32), lengths), sizes) * np.int32(DIMS) + grams
        keys.sort()
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.diff(np.append(first, keys.size))
        keys = keys[first]
        weight = (counts * self.idf[keys % DIMS]) ** 2
        norm = np.sqrt(np.bincount(keys // DIMS, weight, minlength=len(rows)))
        out[full] = dots / np.maximum(norm, 1e-9)[:, None]
        return out

    def classify(self, segments: list[list[str]], home: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Language number (-1: rejected) and confidence of each segment.

        ``home`` numbers the texts that the segments come from (ascending).  The
        confidence is how much nearer the nearest language is than the next, as a
        share of both cosines.
        """
        n = len(segments)
        best, gap, conf, ok = np.zeros(n, np.int64), np.zeros(n), np.zeros(n), np.zeros(n, bool)
        # Centroids of one language stand together, so reduceat gives each language's best.
        firsts = np.flatnonzero(np.concatenate([[True], self.owner[1:] != self.owner[:-1]]))
        for a in range(0, n, BLOCK):
            sims = self.cosines(segments[a : a + BLOCK])
            m = len(sims)
            top = np.maximum.reduceat(sims, firsts, axis=1)
            near = sims.argmax(1)
            lang = self.owner[near]
            s1 = top[np.arange(m), lang]
            top[np.arange(m), lang] = 0
            s2 = top.max(1)
            size = np.fromiter(map(len, segments[a : a + BLOCK]), np.int64, m)
            best[a : a + m], gap[a : a + m] = lang, s1 - s2
            ok[a : a + m] = (size >= self.min_words) & (s1 >= self.least[near])
            conf[a : a + m] = (s1 - s2) / np.maximum(s1 + s2, 1e-9)
        sure = ok & (gap >= self.min_gap)
        if home is not None and n:
            # The language with the largest summed gap in a text needs less to be accepted.
            votes = np.zeros((home[-1] + 1, len(self.names)))
            np.add.at(votes, (np.asarray(home), best), np.where(ok, gap, 0))
            sure |= ok & (gap >= self.own_gap) & (votes.argmax(1)[home] == best)
        return np.where(sure, best, -1), np.clip(conf, 0, 1)


def language_weight(tf: np.ndarray, y: np.ndarray, languages: int) -> np.ndarray:
    """The inverse language frequency of each n-gram: 1 where one language has it, a quarter where all share it alike.

    The number of languages is counted by the entropy of their shares, so that a
    language with a few stray samples counts little.
    """
    rate = np.stack([(tf[y == j] > 0).mean(0) if (y == j).any() else np.zeros(tf.shape[1]) for j in range(languages)])
    p = rate / np.maximum(rate.sum(0), 1e-12)
    entropy = -(p * np.log(np.maximum(p, 1e-12))).sum(0)
    return 0.25 + 0.75 * (1 - entropy / np.log(max(2, languages)))


def fit_model(samples: list[tuple[str, str]], centroids: int = 4, quantile: float = 0.01) -> LanguageModel:
    """Fit on (language, segment) pairs of known language; deterministic."""
    names = sorted({lang for lang, _ in samples})
    words = [words_of(s) for _, s in samples]
    tf = dense_counts(words)
    y = np.array([names.index(lang) for lang, _ in samples])
    idf = ((np.log((1 + len(samples)) / (1 + (tf > 0).sum(0))) + 1) * language_weight(tf, y, len(names))).astype(np.float32)
    x = _unit(tf * idf)
    owner, cents, least = [], [], []
    for j in range(len(names)):
        c, own = spherical_kmeans(x[y == j], centroids)
        near = (x[y == j] * c[own]).sum(1)
        # Farther than half the distance-quantile of its own samples is no member of the language.
        floor = 0.5 * np.quantile(near, quantile)
        owner += [j] * len(c)
        cents.append(c)
        least += [floor] * len(c)
    return LanguageModel(names, np.array(owner), np.concatenate(cents).astype(np.float32), idf, np.array(least, np.float32))


def sample_segments(rows: Iterable[tuple[str, str]], part: bool = False) -> list[tuple[str, str]]:
    return [(lang, text[a:b]) for lang, text in rows if text for a, b in segment_spans(text, part) if len(words_of(text[a:b])) >= 3]


def train(samples: DataFrame, labelled: list[tuple[DataFrame, bool]] = (), sample_rows: int = 600) -> LanguageModel:
    """Fit on ``samples`` (lang, text), then once more together with labelled rows.

    ``labelled`` holds frames (row_no, text, source_language) with a flag for labels.
    Of each at most ``sample_rows`` rows (the documented bound; the rows with the
    smallest hash) are collected.  Their segments are used only where the first
    model agrees with the declared language, since declarations may be wrong.
    """
    known = sample_segments(samples.where("lang is not null and text is not null").orderBy("lang", "text").select("lang", "text").collect())
    if not known:
        raise ValueError("no sample of known language")
    model = fit_model(known)
    more: list[tuple[str, str]] = []
    for df, part in labelled:
        rows = (
            df.select("row_no", "text", declared_language(F.col("source_language")).alias("lang"))
            .where("lang is not null and text is not null")
            .orderBy(F.xxhash64("row_no", "text"))
            .limit(sample_rows)
            .select("lang", "text")
            .collect()
        )
        more += sample_segments([(r.lang, canonical_text(r.text)) for r in rows if r.lang in model.names], part)
    if more:
        best, conf = model.classify([words_of(s) for _, s in more])
        kept = [m for m, b, c in zip(more, best, conf) if b >= 0 and model.names[b] == m[0]]
        known = known + kept
        model = fit_model(known)
    model._samples = known
    return model


def widen(model: LanguageModel, likely: list[tuple[str, str]]) -> LanguageModel:
    """Fit once more together with segments of likely but unsure language (language, segment).

    A first fit with one centroid per language, which single wrong segments hardly
    move, tells which of them to believe.
    """
    likely = [x for x in likely if x[0] in model.names and len(words_of(x[1])) >= model.min_words]
    if not likely:
        return model
    rough = fit_model(model._samples + likely, centroids=1)
    best, _ = rough.classify([words_of(s) for _, s in likely], list(range(len(likely))))
    samples = model._samples + [x for x, b in zip(likely, best) if b >= 0 and rough.names[b] == x[0]]
    wide = fit_model(samples)
    wide._samples = samples
    return wide


SEGMENTS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType()), T.StructField("confidence", T.DoubleType())]))
_SEGMENT_TYPE = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64())])


def classify_texts(texts: list[str | None], model: LanguageModel, part: bool) -> list[list[tuple[int, int, int, float]]]:
    """(start, end, language number or -1, confidence) of the segments of each text.

    Offsets count characters of the canonical form.  Where no segment of a text is
    certain alone, the text is tried as a whole.
    """
    spans, words, home = [], [], []
    whole: list[list[str]] = []
    for k, text in enumerate(texts):
        every: list[str] = []
        for a, b in segment_spans(text, part) if text else ():
            ws = words_of(text[a:b])
            if ws:
                spans.append((a, b))
                words.append(ws)
                home.append(k)
                every += ws
        whole.append(every)
    best, conf = model.classify(words, home)
    out: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
    sure = [False] * len(texts)
    for k, (a, b), lang, c in zip(home, spans, best.tolist(), conf.tolist()):
        out[k].append((a, b, lang, c))
        sure[k] |= lang >= 0
    again = [k for k in range(len(texts)) if not sure[k] and len(out[k]) > 1]
    if again:
        best, conf = model.classify([whole[k] for k in again], list(range(len(again))))
        for k, lang, c in zip(again, best.tolist(), conf.tolist()):
            if lang >= 0:
                out[k] = [(0, len(texts[k]), lang, c)]
    return out


def identify(df: DataFrame, key: str, field: str, model: LanguageModel, part: bool = False) -> DataFrame:
    """``key`` and ``segments``: the language and confidence of each segment of ``field``.

    ``part`` splits at the separators of labels instead of at sentences.  A segment
    without a certain language has a null ``lang``; a null, empty or wordless text has
    no segments.  Repeated rows are treated each for itself.  One narrow pass.
    """
    src = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{field}`").alias("text"))
    names = [*model.names, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4000):
                piece = batch.slice(a, 4000)
                found = classify_texts([canonical_text(t) for t in piece.column(1).to_pylist()], model, part)
                offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
                flat = [s for row in found for s in row]
                cols = list(zip(*flat)) if flat else [(), (), (), ()]
                segs = pa.StructArray.from_arrays(
                    [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array([names[i] for i in cols[2]], pa.string()), pa.array(cols[3], pa.float64())], fields=list(_SEGMENT_TYPE)
                )
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.ListArray.from_arrays(pa.array(offsets), segs)], names=["key", "segments"])

    kind = src.schema["key"].dataType
    return src.mapInArrow(run, T.StructType([T.StructField("key", kind), T.StructField("segments", SEGMENTS)]))


def wrong_labels(df: DataFrame, key: str, field: str, declared: str, model: LanguageModel, part: bool = False) -> DataFrame:
    """One row (key, lang) per language of each field whose declared language is missing, wrong or not the only one."""
    # The declared language travels in the key, so no join is needed.
    packed = df.select(F.struct(F.col(f"`{key}`").alias("key"), declared_language(F.col(f"`{declared}`")).alias("said")).alias("key"), F.col(f"`{field}`").alias("text"))
    langs = F.array_distinct(F.filter(F.transform("segments", lambda s: s["lang"]), lambda x: x.isNotNull()))
    return (
        identify(packed, "key", "text", model, part)
        .select("key.key", "key.said", langs.alias("langs"))
        .where((F.size("langs") > 1) | ((F.size("langs") == 1) & (F.col("said").isNull() | (F.col("said") != F.col("langs")[0]))))
        .select("key", F.explode("langs").alias("lang"))
    )
