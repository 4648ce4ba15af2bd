"""Problem 9: scores for abusive, hateful and sexual wording.

Method: the words of the lexicon stand in a trie.  A word of a text is looked up by
intersecting its Levenshtein automaton with the trie, so misspelled and disguised words
(letters as figures or signs, letters apart, masked, repeated or swapped letters) still
meet their term.  The lexicon has two parts: general terms of seven languages in classes
(``abuse_terms.py``), and words learned from judged documents.

The terms found in the window of a sentence are put together to features of the window:
which classes meet, whether a hostile word is aimed at somebody, whether the terms stand
in quotation marks or beside words of rules and reports.  A logistic model turns them
into a score from 0 to 1 for each category.  Its weights start from those below, which
hold without any judged document, and are fitted to a bounded sample of judged ones.

The score of a document in a category is that of its worst window.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import abuse_terms as terms
from quire.llm.canonical import canonical_text

CATEGORIES = ("abusive", "hateful", "sexual")

# Figures and signs that stand for a letter.
_SIGNS = str.maketrans("013457$@€", "oieastsae")

_SENTENCE = re.compile(r"(?<=[.!?])[\"”»)]*\s+|\n+")
_PIECE = re.compile(r"[^\s\"“”«»„,;:!?()\[\]/’'–—|]+|[\"“”«»„]")
_CODE = re.compile(r"[a-z]{1,4}-\d[\w-]*|\d+")
_APART = re.compile(r"(?:[^\W_]\.){2,}[^\W_]?")
_REPEAT = re.compile(r"(.)\1{2,}")
_MARKS = re.compile("[" + "".join(re.escape(chr(c)) for c in range(0x300, sys.maxunicode + 1) if unicodedata.combining(chr(c))) + "]+")
_LATIN_MARKS, _FAR = re.compile("[\u0300-\u036f]+"), re.compile("[\u0483-\u1fff\u2c00-\U0010ffff]")
_OPEN, _CLOSE = "\"“«„", "\"”»“"


def fold(text: str) -> str:
    """Lower case without accents."""
    if text.isascii():
        return text.lower()
    out = _LATIN_MARKS.sub("", unicodedata.normalize("NFD", text.casefold()))
    return _MARKS.sub("", out) if _FAR.search(out) else out


def plain_words(piece: str) -> tuple[str, ...]:
    """The plain spelling of a disguised, folded piece of text; ``*`` stays for a masked letter."""
    p = piece.strip("-_#~+=<>&%^`´")
    if not p or _CODE.fullmatch(p.rstrip(".")):
        return ()
    if _APART.fullmatch(p.rstrip(".")) or _APART.fullmatch(p):
        p = p.replace(".", "")
    p = p.strip(".")
    if not p.isalpha():
        if any(c.isalpha() or c in "$@*" for c in p):
            p = p.translate(_SIGNS)
        if "-" in p or "." in p:
            return tuple(w for x in re.split(r"[-.]+", p) for w in plain_words(x))
        p = "".join(c for c in p if c.isalpha() or c == "*")
    p = _REPEAT.sub(r"\1", p) if not p.startswith("**") or p.strip("*") else ""
    return (p,) if p.strip("*") else ()


class Trie:
    """Words of the lexicon, searched with a Levenshtein automaton; ``a longer one of ``stems`` may be followed by up to three letters."""

    ENDING = 5

    def __init__(self, words: set[str], stems: frozenset[str] = frozenset()) -> None:
        self.root: dict = {}
        self.stems = stems
        for w in words:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w

    def near(self, word: str, edits: int, first: str | None = None) -> list[str]:
        """Lexicon words within ``edits`` insertions, deletions or substitutions; ``*`` in ``word`` is any letter.

        With ``first``, only words that begin with this letter.

        The automaton runs bit-parallel: bit i of level d is set when i letters of
        ``word`` may have been read with d edits.  A branch of the trie is left as
        soon as no state is active.
        """
        n = len(word)
        every, any_letter = (1 << n + 1) - 1, 0
        masks: dict[str, int] = {}
        for i, c in enumerate(word):
            if c == "*":
                any_letter |= 2 << i
            else:
                masks[c] = masks.get(c, 0) | 2 << i
        found: list[str] = []
        stack = [(self.root, [(2 << d) - 1 & every for d in range(edits + 1)])]
        while stack:
            node, levels = stack.pop()
            # A short stem with an ending is too common to be met with a slip.
            if "" in node and levels[edits] >> (max(0, n - 3) if len(node[""]) > 4 and node[""] in self.stems else n):
                found.append(node[""])
            for c, child in node.items():
                if c and (first is None or c == first or node is not self.root):
                    m = masks.get(c, 0) | any_letter
                    new = [levels[0] << 1 & m]
                    for d in range(edits):
                        new.append((levels[d + 1] << 1 & m | levels[d] << 1 | levels[d] | new[d] << 1) & every)
                    if new[edits]:
                        stack.append((child, new))
        return found


def allowed_edits(word: str) -> int:
    """No edit for short words, one from five letters, two from ten; masked letters are free but take one edit away."""
    n = len(word)
    return max(0, (n >= 5) + (n >= 10) - ("*" in word))


CLASSES = ("INSULT", "SCORN", "HOSTILE", "BODY", "ADDRESS", "GROUP", "VERMIN", "EXPEL", "EXPLICIT", "INTIMATE", "MENTION")
INSULT, SCORN, HOSTILE, BODY, ADDRESS, GROUP, VERMIN, EXPEL, EXPLICIT, INTIMATE, MENTION = range(len(CLASSES))
# What a term can add to a score at most, roughly.  A window is looked at only if its terms can outweigh the bias.
REACH = {INSULT: 5, EXPLICIT: 5, SCORN: 3, HOSTILE: 3, VERMIN: 3, EXPEL: 3, INTIMATE: 3, ADDRESS: 1.5, GROUP: 1.5, BODY: 1}
LEAST_REACH = 3.2

# Features of a window with their weights (abusive, hateful, sexual) before any document is judged.
WEIGHTS = {
    "bias": (-4.2, -4.4, -4.2), "idiom": (5.6, -1, 0), "insult": (4.2, -0.5, -0.5), "insults": (1, 0, 0), "insult aimed": (1.6, -0.5, 0), "scorn aimed": (2.4, 0, 0), "scorn": (0.6, 0.2, 0), "scorns": (1.2, 0, 0),
    "hostile": (0.7, 0.3, 0), "hostile aimed": (3.2, -0.3, 0), "hostiles": (0.7, 0, 0), "hostile body": (0.9, 0, 0), "hostile insult": (0.8, 0, 0), "hostile group": (-1, 2.6, 0),
    "vermin": (0, 1.6, 0), "vermins": (0, 1.4, 0), "vermin group": (-0.8, 2.3, 0), "vermin expel": (-0.8, 2, 0), "expel": (0, 0.5, 0), "expels": (0, 1.2, 0), "expel group": (-0.5, 2, 0), "insult group": (-1, 1.2, 0), "group": (-0.5, 0.4, 0),
    "explicit": (-0.3, 0, 3.2), "explicits": (-0.3, 0, 2), "intimate": (0, 0, 1.3), "intimates": (0, 0, 1.6), "intimate third": (0, 0, 2.2), "explicit intimate": (-0.3, 0, 1),
    "mention": (-1.6, -0.8, -0.8),
}
FEATURES = tuple(WEIGHTS)
_AT = {name: i for i, name in enumerate(FEATURES)}
THRESHOLD = 0.7
QUOTED = 0.25  # how much a term in quotation marks counts


class Lexicon:
    """Terms with their classes, idioms, learned words, and the trie over all of them."""

    def __init__(self, known: frozenset[str] = frozenset(), learned: tuple[str, ...] = (), reach: tuple[float, ...] = ()) -> None:
        self.classes: dict[str, set[int]] = {}
        stems = set()
        for c, name in enumerate(CLASSES):
            table = getattr(terms, name)
            for line in table.values() if isinstance(table, dict) else [table]:
                for term in line.split():
                    w = fold(term.rstrip("*")).replace("-", "")
                    self.classes.setdefault(w, set()).add(c)
                    if term.endswith("*"):
                        stems.add(w)
        self.subject = frozenset(terms.SUBJECT.split())
        self.idioms = [tuple(fold(line).split()) for lines in terms.IDIOMS.values() for line in lines.split("|")]
        self.idioms_of: dict[str, list[int]] = {}
        for i, ws in enumerate(self.idioms):
            self.idioms_of.setdefault(min(ws, key=lambda w: (-len(w), w)), []).append(i)
        self.learned = {w: i for i, w in enumerate(learned)}
        in_idioms = {w for ws in self.idioms for w in ws}
        self.words = set(self.classes) | in_idioms | set(learned)
        self.stems = frozenset(stems)
        self.longest = max(map(len, stems))
        self.trie = Trie(self.words, self.stems)
        self.known = known
        self.correct = Trie({w for w in known if w not in self.words})
        self.reach = {w: max([REACH.get(c, 0) for c in self.classes.get(w, ())] + [5 * (w in self.idioms_of)]) for w in self.words}
        for w, i in self.learned.items():
            self.reach[w] += reach[i] if reach else 2
        self.seen: dict[str, tuple] = {}

    def lookup(self, word: str) -> tuple[str, ...]:
        """The lexicon words that ``word`` may be; a correctly spelled other word, or a slip in one, is none of them."""
        plain = [word] if word in self.words else []
        plain += [word[:n] for n in range(max(3, len(word) - Trie.ENDING), min(len(word), self.longest + 1)) if word[:n] in self.stems]
        if plain:
            return tuple(plain)
        edits = allowed_edits(word)
        if word in self.known or (not edits and "*" not in word and len(word) < 4):
            return ()
        # Two letters swapped are one slip.
        swapped = [w for i in range(len(word) - 1) if (w := word[:i] + word[i + 1] + word[i] + word[i + 2 :]) in self.words]
        # A slip in the first letter is rare, and makes "lover" of "cover".
        found = swapped or (self.trie.near(word, edits, None if word[0] == "*" else word[0]) if edits or "*" in word else [])
        if found and "*" not in word and self.correct.near(word, 1):
            return ()
        return tuple(found)

    def read(self, piece: str) -> tuple:
        """(what its terms can add, ((plain word, its lexicon words), ...)) of a piece of text."""
        if len(self.seen) > 300_000:
            self.seen.clear()
        words = tuple((w, self.lookup(w)) for w in plain_words(piece))
        got = self.seen[piece] = (sum(max((self.reach[f] for f in found), default=0) for _, found in words), words)
        return got


def window(sentence: str, lex: Lexicon) -> tuple[np.ndarray, tuple[int, ...]] | None:
    """The features of the window of a sentence and the learned words in it; None where too little is said."""
    pieces = _PIECE.findall(sentence)
    seen = lex.seen
    got = [seen.get(p) or lex.read(p) for p in pieces]
    if sum([g[0] for g in got]) < LEAST_REACH:
        return None
    inside, n = False, 0
    spots: list[list[tuple[int, float]]] = [[] for _ in CLASSES]
    places: dict[str, list[tuple[int, float]]] = {}
    learned: dict[int, float] = {}
    for piece, (_, words) in zip(pieces, got):
        if len(piece) == 1 and piece in _OPEN + _CLOSE:
            inside = not inside if piece == '"' else piece in "“«„"
            continue
        weight = QUOTED if inside else 1.0
        for w, found in words:
            for f in found:
                for c in lex.classes.get(f, ()):
                    if not spots[c] or spots[c][-1][0] != n:
                        spots[c].append((n, weight))
                places.setdefault(f, []).append((n, weight))
                if f in lex.learned:
                    learned[lex.learned[f]] = max(weight, learned.get(lex.learned[f], 0))
            n += 1
    x = np.zeros(len(FEATURES))
    have = [sorted((w for _, w in s), reverse=True) + [0.0, 0.0, 0.0] for s in spots]

    def near(a: int, b: int, reach: int, behind: bool = False) -> float:
        return max((min(u, v) for i, u in spots[a] for j, v in spots[b] if i != j and (0 if behind else -reach) <= j - i <= reach), default=0.0)

    def aimed(c: int, reach: int) -> float:
        """Whether a term of the class stands near a word for somebody spoken to."""
        at = [(j, v, s) for s in (True, False) for w, ps in places.items() if ADDRESS in lex.classes.get(w, ()) and (w in lex.subject) == s for j, v in ps]
        return max((min(u, v) for i, u in spots[c] for j, v, s in at if i != j and (0 if s and c == HOSTILE else -reach) <= j - i <= reach), default=0.0)

    def put(name: str, value: float) -> None:
        x[_AT[name]] = value

    put("bias", 1)
    for i in {i for w in places for i in lex.idioms_of.get(w, ())}:
        ws = lex.idioms[i]
        if all(w in places for w in ws):
            for at, weight in places[min(ws, key=lambda w: (-len(w), w))]:
                if all(any(abs(j - at) <= len(ws) for j, _ in places[w]) for w in ws):
                    put("idiom", max(x[_AT["idiom"]], weight))
    for name, c in (("insult", INSULT), ("scorn", SCORN), ("hostile", HOSTILE), ("vermin", VERMIN), ("expel", EXPEL), ("explicit", EXPLICIT), ("intimate", INTIMATE), ("group", GROUP), ("mention", MENTION)):
        put(name, have[c][0])
    for name, c in (("insults", INSULT), ("scorns", SCORN), ("hostiles", HOSTILE), ("vermins", VERMIN), ("expels", EXPEL), ("explicits", EXPLICIT), ("intimates", INTIMATE)):
        put(name, have[c][1])
    put("intimate third", have[INTIMATE][2])
    put("insult aimed", aimed(INSULT, 6))
    put("scorn aimed", aimed(SCORN, 5))
    put("hostile aimed", aimed(HOSTILE, 3))
    for name, a, b, reach in (("hostile body", HOSTILE, BODY, 4), ("hostile insult", HOSTILE, INSULT, 8), ("hostile group", HOSTILE, GROUP, 4), ("vermin group", VERMIN, GROUP, 12), ("vermin expel", VERMIN, EXPEL, 12), ("expel group", EXPEL, GROUP, 8), ("insult group", INSULT, GROUP, 8), ("explicit intimate", EXPLICIT, INTIMATE, 15)):
        put(name, near(a, b, reach))
    return x, tuple(sorted(learned.items()))


@dataclass
class AbuseModel:
    """Weights of the features (features x categories) and of the learned words (words x categories)."""

    known: frozenset[str] = frozenset()
    weights: np.ndarray = field(default_factory=lambda: np.array(list(WEIGHTS.values()), float))
    learned: tuple[str, ...] = ()
    learned_weights: np.ndarray = field(default_factory=lambda: np.zeros((0, len(CATEGORIES))))

    def lexicon(self) -> Lexicon:
        return Lexicon(self.known, self.learned, tuple(self.learned_weights.max(1, initial=0)))

    def score(self, sentence: str, lex: Lexicon) -> np.ndarray | None:
        """Scores of one sentence, None where nothing is said."""
        got = window(sentence, lex)
        if got is None:
            return None
        z = got[0] @ self.weights
        for i, weight in got[1]:
            z = z + self.learned_weights[i] * weight
        return 1 / (1 + np.exp(-z))


def sentences_of(text: str | None) -> list[str]:
    return _SENTENCE.split(fold(canonical_text(text))) if text else []


def score_text(text: str | None, lex: Lexicon, model: AbuseModel | None = None) -> tuple[float, float, float]:
    """Scores (abusive, hateful, sexual) of a whole text: its worst sentence in each category."""
    model = model or AbuseModel()
    best = np.zeros(len(CATEGORIES))
    for sentence in sentences_of(text):
        s = model.score(sentence, lex)
        if s is not None:
            best = np.maximum(best, s)
    return tuple(round(float(b), 4) for b in best)


def _logistic(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, y: np.ndarray, sure: np.ndarray, start: np.ndarray, pull: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Weights that fit ``y`` with each row counted ``sure`` times, held near ``start`` with the strength ``pull``; Adam, deterministic.

    The matrix is given by the places and values of what is not zero.
    """
    w, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for step in range(1, rounds + 1):
        z = np.bincount(rows, vals * w[cols], len(y))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        grad = np.bincount(cols, vals * ((p - y) * sure)[rows], len(w)) + pull * (w - start)
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad**2
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w


def best_cut(z: np.ndarray, true: np.ndarray, low: float = -2.0, high: float = 0.85) -> float:
    """The limit between ``low`` and ``high`` that tells true from other documents best, a missed one counting three times (F3), in the middle of its gap."""
    order = np.argsort(-z)
    hit = np.cumsum(true[order])
    score = 10 * hit / (np.arange(1, len(z) + 1) + 9 * true.sum())
    top = z[order]
    score[(top < low) | (top > high)] = -1
    if not (score >= 0).any():
        return high
    at = int(score.argmax())
    below = top[at + 1] if at + 1 < len(top) else low
    return float((top[at] + max(below, low)) / 2)


def fit(judged: list[tuple[str, str]], known: frozenset[str] = frozenset(), rounds: int = 3) -> AbuseModel:
    """Fit the model to judged documents (text, category).

    A judgement says only that some sentence of the document is such; which one is
    found with the fit in turns: the sentence with the highest score stands for its
    document, all other sentences of all documents count as harmless.  Words that stand
    in three or more documents of a category (five, if clean samples hold them), and there clearly more often than in
    harmless ones, become learned words.
    """
    docs = [(list(dict.fromkeys(s for s in sentences_of(t) if s.strip())), c) for t, c in judged]
    held: dict[str, Counter] = {c: Counter() for c in (*CATEGORIES, "none")}
    count = Counter(c for _, c in docs)
    plain: dict[str, frozenset] = {}
    for sentences, c in docs:
        words = set()
        for s in sentences:
            if s not in plain:
                plain[s] = frozenset(w for p in _PIECE.findall(s) for w in plain_words(p) if len(w) > 2 and "*" not in w)
            words |= plain[s]
        held[c].update(words)
    odds: dict[str, dict[str, float]] = {}
    for c in CATEGORIES:
        rest = sum((held[o] for o in held if o != c), Counter())
        others = sum(count[o] for o in held if o != c)
        each = {w: np.log((n + 0.5) / (count[c] + 1)) - np.log((rest[w] + 0.5) / (others + 1)) for w, n in held[c].items() if n >= (5 if w in known else 3)}
        odds[c] = {w: o for w, o in each.items() if o >= 1.2}
    learned = tuple(sorted({w for o in odds.values() for w in o}))
    model = AbuseModel(known, learned=learned, learned_weights=np.zeros((len(learned), len(CATEGORIES))))
    lex = Lexicon(known, learned)
    rows, cols, vals, owner = [], [], [], []
    for d, (sentences, _) in enumerate(docs):
        for s in sentences:
            got = window(s, lex)
            if got is None:
                continue
            at = np.flatnonzero(got[0])
            cols += [*at, *(len(FEATURES) + i for i, _ in got[1])]
            vals += [*got[0][at], *(weight for _, weight in got[1])]
            rows += [len(owner)] * (len(at) + len(got[1]))
            owner.append(d)
    if not rows:
        return model
    rows, cols, vals, owner = np.array(rows), np.array(cols), np.array(vals), np.array(owner)
    kinds = np.array([c for _, c in docs])
    weights = np.concatenate([model.weights, model.learned_weights])
    pull = np.concatenate([np.full(len(FEATURES), 1.0), np.full(len(learned), 0.3)])
    pull[_AT["bias"]] = 4.0
    for k, c in enumerate(CATEGORIES):
        mine = np.flatnonzero(kinds[owner] == c)
        if not mine.size:
            continue
        # The first choice goes by the general terms and by the odds of the words.
        start = weights[:, k].copy()
        w = start.copy()
        w[len(FEATURES) :] = [min(2.0, odds[c].get(x, 0) / 2) for x in learned]
        for turn in range(rounds):
            z = np.bincount(rows, vals * w[cols], len(owner))
            y, sure = np.zeros(len(owner)), np.ones(len(owner))
            order = mine[np.lexsort((-z[mine], owner[mine]))]
            first = order[np.concatenate([[True], owner[order][1:] != owner[order][:-1]])]
            y[first] = 1
            # Sentences of the document beside the chosen one may be such, too.
            sure[mine] = 0.3
            sure[first] = 1
            if turn:
                # Judgements that the fit clearly contradicts are probably wrong.
                sure[(y == 1) & (z < -1) | (y == 0) & (z > 0.5)] = 0.1
            w = _logistic(rows, cols, vals, y, sure, start, pull)
        if count[c] >= 20:
            # Some judgements are wrong, which draws the scores of true cases down; the limit that
            # tells the judged documents best comes to lie at THRESHOLD.
            worst = np.full(len(docs), -np.inf)
            np.maximum.at(worst, owner, np.bincount(rows, vals * w[cols], len(owner)))
            w[_AT["bias"]] += np.log(THRESHOLD / (1 - THRESHOLD)) - best_cut(worst, kinds == c)
        weights[:, k] = w
    model.weights, model.learned_weights = weights[: len(FEATURES)], weights[len(FEATURES) :]
    return model


def train(docs: DataFrame, labels: DataFrame, key: str, field: str, known: frozenset[str] = frozenset(), sample_docs: int = 4000) -> AbuseModel:
    """Fit to at most ``sample_docs`` judged documents (the documented bound; those with the smallest hash).

    A document judged differently is left out unless most judgements agree.  Without
    judged documents the weights stay as they are.
    """
    votes = labels.select(F.col(f"`{key}`").alias("id"), F.lower(F.trim("category")).alias("category")).where(F.col("category").isin(*CATEGORIES, "none")).groupBy("id", "category").count()
    top = votes.groupBy("id").agg(F.max(F.struct("count", "category")).alias("t"), F.sum("count").alias("all")).where(F.col("t.count") * 2 > F.col("all"))
    sample = top.select("id", F.col("t.category").alias("category")).orderBy(F.xxhash64("id"), "id").limit(sample_docs)
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{field}`").alias("text")).where("text is not null").join(F.broadcast(sample), "id").select("id", "text", "category").dropDuplicates(["id"]).collect()
    return fit([(r["text"], r["category"]) for r in sorted(rows, key=lambda r: (r["id"], r["text"]))], known)


def known_words(samples: DataFrame, field: str = "text") -> frozenset[str]:
    """The words of clean sample texts (a fixed small table), which are never taken for misspelled ones."""
    rows = samples.select(field).where(F.col(field).isNotNull()).collect()
    return frozenset(w for r in rows for piece in _PIECE.findall(fold(canonical_text(r[0]))) for w in plain_words(piece))


def score_documents(df: DataFrame, key: str, field: str, *more: str, model: AbuseModel | None = None) -> DataFrame:
    """``key``, further columns, and the scores abusive, hateful and sexual of every row.

    Null and empty texts score 0.  Texts of any length are read whole, sentence by
    sentence.  Equal texts score equally.  One narrow pass.
    """
    model = model or AbuseModel()
    src = df.select(*(F.col(f"`{c}`") for c in dict.fromkeys([key, *more])), F.col(f"`{field}`").alias("scored text"))
    kept = src.columns[:-1]
    kinds = ", ".join(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = model.lexicon()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                scores = list(zip(*(score_text(t, lex, model) for t in part.column(len(kept)).to_pylist())))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(kept))), *(pa.array(s, pa.float64()) for s in scores)], names=[*kept, *CATEGORIES])

    return src.mapInArrow(run, f"{kinds}, abusive double, hateful double, sexual double")


def flagged(scores: DataFrame, key: str, threshold: float = THRESHOLD) -> DataFrame:
    """One row (key, category) for every score of at least ``threshold``."""
    pairs = F.array(*[F.struct(F.lit(c).alias("category"), F.col(c).alias("score")) for c in CATEGORIES])
    return scores.select(F.col(f"`{key}`"), F.explode(pairs).alias("x")).where(F.col("x.score") >= threshold).select(F.col(f"`{key}`"), "x.category")


def rates(scores: DataFrame, source: str, threshold: float = THRESHOLD) -> DataFrame:
    """Per source: documents, and number and share of those flagged in each category; null is a source of its own."""
    counts = [F.sum((F.col(c) >= threshold).cast("long")).alias(c) for c in CATEGORIES]
    per = scores.groupBy(source).agg(F.count("*").alias("documents"), *counts)
    return per.select(source, "documents", *CATEGORIES, *[F.round(F.col(c) / F.col("documents"), 6).alias(f"{c}_rate") for c in CATEGORIES])
