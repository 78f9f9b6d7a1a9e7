"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier on its posterior labels.

Voters look at a whole text and fire or stay silent: lexicons of insults by kind, patterns (second person beside an
insult, threats, masked words, heaping), courtesy as a voter for the other side, and lists of words and word beginnings
drawn from labelled training rows. Which voters fired makes a pattern; there are at most 2^voters of them, so the
corpus becomes a small table of pattern counts whatever its size.

The label model is a tree-augmented mixture fitted on these counts by expectation maximisation: each voter has its
accuracy for both classes, and depends on the class and on one other voter, along the spanning tree of the largest
conditional mutual information, so correlated voters do not count twice. Labelled training rows keep their class in it;
all documents take part without a label. Its posteriors label a bounded sample of documents, on which a linear
classifier over log counts of listed words, their density and the votes is fitted. Every document is scored.

Labels of rows held out (crc32 of the id modulo 4 is 2) are never read. Bounds: the lists come from about
``LABELLED_ROWS`` labelled rows, the classifier from about ``FIT_ROWS`` documents, chosen by a hash of id and text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tidemerge.llm.base import query, remainder, stored, table

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
LABELLED_ROWS = 20_000
FIT_ROWS = 20_000
LISTED = 256
BEGINNINGS = (4, 5, 6, 7)
REPEATED = 3
ROUNDS = 60

# Insults by kind in English, German, French and Spanish, and words of courtesy.
LEXICONS = {
    "mind": "idiot idiots moron morons stupid dumb fool fools imbecile cretin halfwit dimwit brainless dumm dummkopf "
            "trottel schwachkopf blöd blödmann débile crétin abruti imbécile estúpido estúpida idiota tonto tonta bobo",
    "worth": "worthless useless pathetic loser losers failure trash garbage nobody nichtsnutz versager wertlos abschaum müll "
             "minable nul nulle raté ordure déchet inútil fracasado fracasada basura patético patética",
    "disgust": "disgusting filthy filth scum vermin pig pigs rat rats maggot cockroach creep ekelhaft widerlich dreck drecksau "
               "schwein dégoûtant dégueulasse vermine porc cochon asqueroso asquerosa cerdo escoria",
    "mockery": "clown clowns joke laughable ridiculous freak weirdo ugly fat lachhaft lächerlich witzfigur hässlich bouffon "
               "ridicule laid moche payaso ridículo ridícula feo fea",
    "profane": "damn bastard bastards bitch ass asshole crap shit bullshit fuck fucking arsch arschloch scheiße scheiß hure "
               "merde connard connasse salope putain mierda puta cabrón pendejo joder",
    "courtesy": "please thanks thank sorry kindly welcome appreciate bitte danke entschuldigung merci pardon désolé gracias perdón",
}
_KINDS = {w: k for k, words in LEXICONS.items() for w in words.split()}
_INSULTS = "|".join(sorted(w for w, k in _KINDS.items() if k != "courtesy"))
PATTERNS = {
    "addressed": re.compile(rf"\b(?:you|your|ur|du|dein|deine|ihr|tu|toi|vous|ton|ta|tú|eres|usted|sois)\b(?:\W+\w+){{0,3}}\W+(?:{_INSULTS})\b"),
    "threat": re.compile(r"\b(?:kill|hurt|hang|shoot|beat) (?:you|yourself|them|him|her|all)\b|\bgo die\b|\bdrop dead\b|\bshut up\b|\bi hate (?:you|them|all)\b"
                         r"|\bhalt(?:'s)? (?:die klappe|maul)\b|\bferme ta gueule\b|\bta gueule\b|\bcállate\b|\bvete al\b"),
    "masked": re.compile(r"\b(?:f[*@#]+c?k?\w*|s[*@#]+t|b[*@#]+ch|a[*@#]{2,}\w*)(?!\w)"),
}
_WORD = re.compile(r"[^\W\d_]+")
#: Voters in the order of their bits.
VOTERS = ["mind", "worth", "disgust", "mockery", "profane", "courtesy", "addressed", "threat", "masked", "heaped",
          "words", "words_again", "beginnings", "beginnings_again", "several", "dense"]


@dataclass
class Lists:
    """Learned entries: words and beginnings of words, each with the number of times a text must hold it."""
    words: dict[str, int] = field(default_factory=dict)
    beginnings: dict[str, int] = field(default_factory=dict)

    @property
    def width(self) -> int:
        return len(self.words) + len(self.beginnings)

    @cached_property
    def slots(self) -> tuple[dict[str, int], dict[str, int], list[int]]:
        """Numbers of the words, of the beginnings after them, and what each entry needs."""
        return ({w: i for i, w in enumerate(self.words)}, {b: i for i, b in enumerate(self.beginnings, len(self.words))},
                [*self.words.values(), *self.beginnings.values()])


def _counted(text: str | None) -> tuple[str, Counter]:
    low = (text or "").lower()
    return low, Counter(_WORD.findall(low))


def _entries(counts: Counter) -> dict[str, int]:
    """Words (``=word``) and beginnings (``^begin``) of a text with their numbers."""
    out: dict[str, int] = {}
    for w, c in counts.items():
        out["=" + w[:40]] = out.get("=" + w[:40], 0) + c
        for n in BEGINNINGS:
            if len(w) > n:
                out["^" + w[:n]] = out.get("^" + w[:n], 0) + c
    return out


def examined(text: str | None, lists: Lists) -> tuple[int, dict[int, int], int]:
    """Pattern of the voters that fire on a whole text, its learned entries with their numbers, its number of words."""
    low, counts = _counted(text)
    n = sum(counts.values())
    fired, insults, hits = set(), 0, {}
    slot_words, slot_begin, needs = lists.slots
    first = len(slot_words)
    for w, c in counts.items():
        kind = _KINDS.get(w)
        if kind is not None:
            fired.add(kind)
            insults += c if kind != "courtesy" else 0
        if w in slot_words:
            hits[slot_words[w]] = hits.get(slot_words[w], 0) + c
        for k in BEGINNINGS:
            if len(w) <= k:
                break
            if (slot := slot_begin.get(w[:k])) is not None:
                hits[slot] = hits.get(slot, 0) + c
    if insults:  # a pattern around an insult needs one
        fired |= {"addressed"} if PATTERNS["addressed"].search(low) else set()
    fired |= {p for p in ("threat", "masked") if PATTERNS[p].search(low)}
    fired |= {"heaped"} if insults >= 2 else set()
    met = [s for s, c in hits.items() if c >= needs[s]]
    for s in met:
        fired.add(("words" if s < first else "beginnings") + ("_again" if needs[s] > 1 else ""))
    fired |= {"several"} if len(met) >= 4 else set()
    fired |= {"dense"} if sum(hits[s] for s in met) * 25 >= max(n, 1) else set()
    return sum(1 << i for i, v in enumerate(VOTERS) if v in fired), hits, n


# --- lists from labelled rows ----------------------------------------------------------------------------------------


def _sampled(rows: DataFrame, share: float, doc_id: str, text: str) -> Column:
    """About ``share`` of the rows, by a hash of id and text; equal rows share their fate."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(11), doc_id, text), 33) < int(min(1.0, share) * (1 << 31))


def known_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` of labelled rows outside the held-out part; ids with unequal labels and null ones are left out."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
            .where("toxic = other and toxic in (0, 1)").select("doc_id", "toxic"))


def labelled(docs: DataFrame, labels: DataFrame, most: int = LABELLED_ROWS) -> DataFrame:
    """``text, toxic`` of about ``most`` labelled documents, each different one once."""
    known = known_labels(labels)
    joined = docs.select("doc_id", "text").join(known, "doc_id")
    chosen = joined.where(_sampled(joined, most / max(1, known.count()), "doc_id", "text"))
    return chosen.groupBy("doc_id", "toxic", F.md5(F.coalesce("text", F.lit(""))).alias("m")).agg(F.first("text").alias("text")).select("text", "toxic")


def learn_lists(rows: DataFrame, most: int = LISTED) -> Lists:
    """The entries that stand out in toxic rows: largest log-odds against the others in units of its own spread."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list[int]] = {}

        def out():
            keys = list(found)
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                                               pa.array([v[0] for v in found.values()], pa.int64()), pa.array([v[1] for v in found.values()], pa.int64())],
                                              ["entry", "level", "clean", "toxic"])

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.setdefault(("", 1), [0, 0])[toxic] += 1
                for e, c in _entries(_counted(text)[1]).items():
                    for level in (1, REPEATED):
                        if c >= level:
                            found.setdefault((e, level), [0, 0])[toxic] += 1
                if len(found) > 200_000:
                    yield out()
                    found = {}
        yield out()

    counts = stored(rows.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(entries, "entry string, level int, clean long, toxic long")
                    .groupBy("entry", "level").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
                    .where("toxic >= 3 or entry = ''"), "toxicity-entries")
    total = counts.where("entry = ''").first()
    if total is None or not total["toxic"] or not total["clean"]:
        return Lists()
    p, q = F.col("toxic"), F.col("clean")
    odds = F.log((p + 0.5) / (total["toxic"] - p + 0.5)) - F.log((q + 0.5) / (total["clean"] - q + 0.5))
    spread = F.sqrt(1 / (p + 0.5) + 1 / (q + 0.5))
    top = (counts.where("entry <> ''").select("entry", "level", odds.alias("odds"), (odds / spread).alias("z"))
           .where("odds > 1.5 and z > 3").orderBy(F.desc("z"), "entry", "level").limit(most).collect())
    lists = Lists()
    for r in top:
        into = lists.words if r["entry"][0] == "=" else lists.beginnings
        into.setdefault(r["entry"][1:], r["level"])
    return lists


# --- the label model -------------------------------------------------------------------------------------------------


class LabelModel:
    """P(class) and, for each voter, P(fires | class, its parent in the tree); ``parents`` has -1 for the root."""

    def __init__(self, voters: int = len(VOTERS)):
        self.voters, self.prior = voters, 0.1
        self.parents = np.full(voters, -1)
        self.fires = np.full((voters, 2, 2), 0.5)  # voter, class, parent's vote

    def _joint(self, votes: np.ndarray) -> np.ndarray:
        out = np.tile(np.log([1 - self.prior, self.prior]), (len(votes), 1))
        for i, parent in enumerate(self.parents):
            on = votes[:, parent] if parent >= 0 else np.zeros(len(votes), int)
            p = self.fires[i][:, on].T
            out += np.log(np.where(votes[:, i, None] > 0, p, 1 - p))
        return out

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        joint = self._joint(votes)
        return 1 / (1 + np.exp(np.clip(joint[:, 0] - joint[:, 1], -700, 700)))

    def accuracies(self, votes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Share of toxic and of clean documents on which each voter fires, by the posteriors."""
        r = self.posterior(votes)
        return np.stack([(w[:, None] * votes).sum(axis=0) / max(w.sum(), 1e-9) for w in (weights * r, weights * (1 - r))], axis=1)

    def _maximise(self, votes: np.ndarray, mass: np.ndarray) -> None:
        """``mass``: weight of each pattern for either class."""
        k, pairs = self.voters, []
        self.prior = float(np.clip((mass[:, 1].sum() + 1) / (mass.sum() + 2), 1e-6, 1 - 1e-6))
        sides = np.stack([1 - votes, votes])  # value, pattern, voter
        for c in range(2):
            pairs.append(np.einsum("p,api,bpj->ijab", mass[:, c], sides, sides) + 0.25)
        information = np.zeros((k, k))
        for joint in pairs:
            p = joint / joint.sum(axis=(2, 3), keepdims=True)
            information += mass.sum() * (p * np.log(p / (p.sum(axis=3, keepdims=True) * p.sum(axis=2, keepdims=True)))).sum(axis=(2, 3))
        inside, self.parents = [0], np.full(k, -1)
        while len(inside) < k:  # spanning tree of the most information
            rest = [i for i in range(k) if i not in inside]
            block = information[np.ix_(inside, rest)]
            a, b = np.unravel_index(block.argmax(), block.shape)
            self.parents[rest[b]] = inside[a]
            inside.append(rest[b])
        for i, parent in enumerate(self.parents):
            for c in range(2):
                t = pairs[c][parent, i] if parent >= 0 else np.tile(pairs[c][i, i].diagonal(), (2, 1))
                self.fires[i, c] = t[:, 1] / t.sum(axis=1)

    def fit(self, votes: np.ndarray, counts: np.ndarray, labelled: np.ndarray, rounds: int = ROUNDS) -> LabelModel:
        """``counts`` of each pattern over all documents, ``labelled`` (clean, toxic) over labelled training rows.

        Labelled rows count for as much as all documents together, so that the classes stay what the labels mean.
        Without toxic labels the first guess is that insulting voters are right.
        """
        if labelled[:, 1].sum() and labelled[:, 0].sum():
            anchored = labelled * max(1.0, counts.sum() / labelled.sum())
        else:
            insulting = votes[:, [i for i, v in enumerate(VOTERS) if v != "courtesy"]].any(axis=1)
            anchored = np.stack([counts * ~insulting, counts * insulting], axis=1) * 0.5
        self._maximise(votes, anchored)
        for _ in range(rounds):
            r = self.posterior(votes)
            before = self.fires.copy()
            self._maximise(votes, anchored + np.stack([counts * (1 - r), counts * r], axis=1))
            if np.abs(self.fires - before).max() < 1e-6:
                break
        return self


def as_votes(patterns: np.ndarray) -> np.ndarray:
    return (patterns[:, None] >> np.arange(len(VOTERS))) & 1


# --- the classifier --------------------------------------------------------------------------------------------------


@dataclass
class Detector:
    """A linear classifier over what ``examined`` finds; ``labels`` is the label model it learnt from."""
    lists: Lists
    weights: np.ndarray
    labels: LabelModel

    def score(self, found: list[tuple[int, dict[int, int], int]]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(inputs(found, self.lists.width) @ self.weights, -700, 700)))


def inputs(found: list[tuple[int, dict[int, int], int]], width: int) -> np.ndarray:
    """Votes, log counts of the learned entries, log and density of all their hits, log of the words, one."""
    x = np.zeros((len(found), len(VOTERS) + width + 4))
    if not found:
        return x
    x[:, :len(VOTERS)] = as_votes(np.array([f[0] for f in found], np.int64))
    for i, (_, hits, n) in enumerate(found):
        total = 0
        for s, c in hits.items():
            x[i, len(VOTERS) + s] = np.log1p(c)
            total += c
        x[i, -4:] = np.log1p(total), total / max(1, n), np.log1p(n) / 10, 1
    return x


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float = 3.0, steps: int = 25) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; without rows every text scores one half."""
    w = np.zeros(x.shape[1])
    if not len(x):
        return w
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w = w - step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-7:
            break
    return w


_FOUND = "pattern long, slots array<int>, numbers array<long>, words long"


def find(docs: DataFrame, lists: Lists, keep: list[str], text: str = "text") -> DataFrame:
    """``pattern, slots, numbers, words`` of each whole text, beside the columns ``keep`` in one struct ``row``."""

    @F.pandas_udf(_FOUND)
    def look(texts: pd.Series) -> pd.DataFrame:
        rows = [examined(t, lists) for t in texts]
        return pd.DataFrame({"pattern": pd.Series([r[0] for r in rows], dtype="int64"), "slots": pd.Series([list(r[1]) for r in rows], dtype="object"),
                             "numbers": pd.Series([list(r[1].values()) for r in rows], dtype="object"), "words": pd.Series([r[2] for r in rows], dtype="int64")})

    return docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), look(F.col(text)).alias("found"))


def _taken(found: pd.DataFrame) -> list[tuple[int, dict[int, int], int]]:
    return [(int(p), dict(zip(map(int, s), map(int, n))), int(w))
            for p, s, n, w in zip(found["pattern"], found["slots"], found["numbers"], found["words"])]


def train(docs: DataFrame, labels: DataFrame, found: DataFrame | None = None, lists: Lists | None = None, sample: DataFrame | None = None) -> Detector:
    """Learns from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic). ``found`` may hold what ``find`` made of docs."""
    sample = stored(labelled(docs, labels), "toxicity-labelled") if sample is None else sample
    lists = learn_lists(sample) if lists is None else lists
    found = stored(find(docs, lists, ["doc_id"]), "toxicity-found") if found is None else found
    # at most 2^voters patterns, whatever the number of documents
    every = found.groupBy("found.pattern").agg(F.count("*").alias("n")).toPandas()
    marked = find(sample, lists, ["toxic"]).groupBy("found.pattern").agg(
        F.count_if(F.col("row.toxic") == 0).alias("clean"), F.count_if(F.col("row.toxic") == 1).alias("bad")).toPandas()
    both = every.merge(marked, on="pattern", how="outer").fillna(0).sort_values("pattern")
    patterns = both["pattern"].to_numpy(np.int64)
    model = LabelModel().fit(as_votes(patterns), both["n"].to_numpy(float), both[["clean", "bad"]].to_numpy(float))
    total = float(every["n"].sum())
    chosen = found.where(F.shiftrightunsigned(F.xxhash64(F.lit(12), "row", "found"), 33) < int(min(1.0, FIT_ROWS / max(1.0, total)) * (1 << 31)))
    # equal finds are one row with a weight, so groups of copies do not fill the sample
    rows = chosen.groupBy("found").agg(F.count("*").alias("n")).select("found.*", "n").toPandas()
    taken = _taken(rows)
    x = inputs(taken, lists.width)
    y = model.posterior(as_votes(np.array([t[0] for t in taken], np.int64))) if taken else np.zeros(0)
    often = np.minimum(rows["n"].to_numpy(int), 8) if taken else np.zeros(0, int)
    return Detector(lists, fit_linear(np.repeat(x, often, axis=0), np.repeat(y, often)), model)


def _score_column(detector: Detector):
    @F.pandas_udf(DoubleType())
    def score(found: pd.DataFrame) -> pd.Series:
        return pd.Series(detector.score(_taken(found)), dtype="float64")

    return score


def scored(docs: DataFrame, detector: Detector, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text, 0 to 1; null and empty texts get the score of an empty text. Repeated
    rows, null ids and other columns stay as they are; a column named ``into`` is replaced."""

    @F.pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(detector.score([examined(t, detector.lists) for t in texts]), dtype="float64")

    return docs.withColumn(into, score(F.col(text)))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are not learnt from; false for a null id."""
    return F.coalesce(remainder(doc_id, FOLDS) == HELD_OUT, F.lit(False))


@query("op11_toxicity")
def op11_toxicity(spark, folder):
    docs, labels = table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "labels", "doc_id", "toxic")
    sample = stored(labelled(docs, labels), "toxicity-labelled")
    lists = learn_lists(sample)
    found = stored(find(docs, lists, ["doc_id"]), "toxicity-found")
    detector = train(docs, labels, found, lists, sample)
    out = found.select(F.col("row.doc_id").alias("doc_id"), _score_column(detector)("found").alias("score"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
