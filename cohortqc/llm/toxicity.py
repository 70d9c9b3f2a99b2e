"""Toxicity by a weighted finite-state pattern grammar: transducers for insult, threat, target, negation and reported
speech are composed over clauses, and matched clauses are scored, not isolated words.

Alphabet classes come from fixed small word lists (threat, target, negation, reporting verbs, in four languages) and
from learned stems: beginnings of words, or whole words, that toxic training documents share and clean ones lack, with
their log odds as weights. Each of the five transducers is a small state table whose arcs multiply two weights, one for
insults and one for threats; ``compose`` builds the one machine whose states are tuples of theirs, once. It reads a
sentence left to right, clause by clause. Insults and threats emit; negation damps the next words; reported speech damps
from a reporting verb to the end of its sentence or quotation, a colon between them or not, and inside quotation marks, whose
state outlasts sentences up to the end of the line; at the end of a clause the target's state says whether its threats
count and its insults are raised. A document's evidence is its strongest clause and the sum of all clauses, and a logistic
curve over both, fitted on the sample's labels, gives the score.

Only sentences with an insult or threat word are read by the machine: an Aho-Corasick pass over the whole text finds
them, so the cost of a clean text is one pass. Of the line before such a sentence only the quotation marks are read.

Lexicon and curve are fitted on a bounded sample: at most ``SAMPLE`` labelled training documents of each class, those
with the smallest hash; of documents that share their least shingle hash (copies) one counts, so that a
much copied document does not make its own words look toxic. The lexicon holds at most ``MAX_STEMS`` learned patterns, those
of the most toxic documents of the sample.

Defined results: a null or empty text has no clause and gets the curve's floor. Null labels and labels of null ids are
not learned from; an id labelled twice takes the larger label. Without labels the fixed lists and fixed curve decide.
Repeated rows get the same score. An empty table gives an empty result.
"""
from __future__ import annotations

import math
import re
from collections import Counter
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc.llm.common import doc_crc, whole, written

SAMPLE = 5000
LEAST_DOCS, LEAST_SHARE, MAX_STEMS = 8, 0.9, 4000
STEM_CHARS = (4, 12)
PATTERNS_HELD = 100_000
PREDICT_AT = 0.3

# Words of the fixed transducers.
INSULTS = ("idiot idiots moron morons stupid scum loser losers pathetic worthless trash disgusting clown clowns imbecile "
           "imbeciles idiota idiotas imbécil estúpido estúpida basura escoria idiote crétin ordure minable idioten "
           "dummkopf abschaum versager").split()
THREATS = "kill hurt destroy murder stab shoot matar matará tuer détruire frapper töten umbringen vernichten".split()
TARGETS = ("you your he she they them him her people everyone tu vous toi il elle ils elles nous ihr du sie dich euch "
           "er ellos ellas usted ustedes él ella").split()
NEGATIONS = "not no never without nicht kein keine nie pas jamais sans ne sin nunca tampoco".split()
REPORTING = ("said says say wrote claims claimed according quoted called sagte sagt schrieb laut dit écrit selon dijo "
             "dice escribió según").split()
INSULT_WEIGHT, THREAT_WEIGHT = 4.0, 4.0
NEGATED, REPORTED, TARGETED, NEGATION_REACH = 0.4, 0.5, 1.25, 3
# Curve without labels: bias, strongest clause, log of one plus the sum.
CURVE = (-4.0, 1.0, 0.5)

WORD = re.compile(r"[^\W\d_]+")
SENTENCE_ENDS = ".!?;\n"
SENTENCE_END = re.compile(f"[{SENTENCE_ENDS}]")
QUOTES = re.compile("[«„»”“\"]")
TOKEN = re.compile("[^\\W\\d_]+|[«„»”“\":]")

# Classes the machines read. A mark that opens in one language and closes in another turns the state over.
CLASSES = "other insult threat target negation report opening closing turning colon sentence line".split()
(OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, OPENING, CLOSING, TURNING, COLON, SENTENCE, LINE) = range(len(CLASSES))
MARKS = {"«": OPENING, "„": OPENING, "»": CLOSING, "”": CLOSING, "“": TURNING, '"': TURNING, ":": COLON}
WORDS, ENDS = (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT), (COLON, SENTENCE, LINE)


class Transducer(NamedTuple):
    """arcs[state][class]: next state and the weights of insults and threats; finals[state]: what a clause that ends
    there multiplies its insults and its threats by. The first state is the start."""
    arcs: list[list[tuple[int, float, float]]]
    finals: list[tuple[float, float]]


def _emitter(of: int, channel: int) -> Transducer:
    """Lets one channel through for one class only."""
    arc = lambda c: (0, 1.0, float(c == of)) if channel else (0, float(c == of), 1.0)
    return Transducer([[arc(c) for c in range(len(CLASSES))]], [(1.0, 1.0)])


def target_machine() -> Transducer:
    """Has the clause named somebody?"""
    arcs = [[(0 if c in ENDS else int(seen or c == TARGET), 1.0, 1.0) for c in range(len(CLASSES))] for seen in (0, 1)]
    return Transducer(arcs, [(1.0, 0.0), (TARGETED, 1.0)])


def negation_machine() -> Transducer:
    """The state is how many further words a negation reaches."""
    def arc(left: int, c: int):
        damp = NEGATED if left else 1.0
        after = 0 if c in ENDS else NEGATION_REACH if c == NEGATION else max(0, left - 1) if c in WORDS else left
        return after, damp, damp
    states = range(NEGATION_REACH + 1)
    return Transducer([[arc(n, c) for c in range(len(CLASSES))] for n in states], [(1.0, 1.0) for _ in states])


def reported_machine() -> Transducer:
    """States: plain, after a reporting verb, in quotation marks. The end of a quotation ends what the verb began."""
    plain, said, quoted = range(3)

    def arc(state: int, c: int):
        damp = REPORTED if state else 1.0
        if c == OPENING or (c == TURNING and state != quoted):
            return quoted, damp, damp
        if c == CLOSING or c == TURNING or c == LINE:
            return plain, damp, damp
        if state != quoted and c in (REPORT, SENTENCE):
            return (said if c == REPORT else plain), damp, damp
        return state, damp, damp
    return Transducer([[arc(s, c) for c in range(len(CLASSES))] for s in (plain, said, quoted)], [(1.0, 1.0)] * 3)


def machines() -> list[Transducer]:
    return [_emitter(INSULT, 0), _emitter(THREAT, 1), target_machine(), negation_machine(), reported_machine()]


def compose(parts: list[Transducer]) -> Transducer:
    """The machine that runs all parts at once: states are tuples of theirs, those that can be reached, and weights
    multiply along arcs and at the ends."""
    states, numbers, arcs = [(0,) * len(parts)], {(0,) * len(parts): 0}, []
    for state in states:  # grows while it is read
        row = []
        for c in range(len(CLASSES)):
            steps = [p.arcs[s][c] for p, s in zip(parts, state)]
            after = tuple(step[0] for step in steps)
            if after not in numbers:
                numbers[after] = len(states)
                states.append(after)
            row.append((numbers[after], math.prod(step[1] for step in steps), math.prod(step[2] for step in steps)))
        arcs.append(row)
    finals = [tuple(math.prod(p.finals[s][k] for p, s in zip(parts, state)) for k in (0, 1)) for state in states]
    return Transducer(arcs, finals)


def fixed_lexicon() -> dict[str, float]:
    """Pattern to weight; a pattern that ends in ``$`` is a whole word, others are beginnings of words."""
    return {f"{w}$": INSULT_WEIGHT for w in INSULTS}


class Grammar:
    def __init__(self, lexicon: dict[str, float], curve: tuple[float, float, float] = CURVE):
        self.lexicon, self.curve = lexicon, curve
        self.stems = {p: w for p, w in lexicon.items() if not p.endswith("$")}
        self.words = {p[:-1]: w for p, w in lexicon.items() if p.endswith("$")}
        self.lengths = sorted({len(s) for s in self.stems})
        lists = ((TARGETS, TARGET), (THREATS, THREAT), (REPORTING, REPORT), (NEGATIONS, NEGATION))
        self.classes = {**MARKS, **{w: kind for words, kind in lists for w in words}}
        self.machine = compose(machines())
        self.finder = ahocorasick.Automaton()
        for pattern in [*self.stems, *self.words, *THREATS]:
            self.finder.add_word(pattern, len(pattern))
        self.finder.make_automaton()

    def insult(self, word: str) -> float:
        """Weight of a word: its own, or that of its longest stem."""
        if word in self.words:
            return self.words[word]
        for n in reversed(self.lengths):
            if n <= len(word) and word[:n] in self.stems:
                return self.stems[word[:n]]
        return 0.0

    def tokens(self, text: str):
        """Class and weight of the words and marks of a lower-cased sentence."""
        for match in TOKEN.finditer(text):
            token = match.group()
            kind = self.classes.get(token)
            if kind is None:
                weight = self.insult(token)
                yield (INSULT if weight else OTHER), weight
            else:
                yield kind, THREAT_WEIGHT

    def sentence(self, text: str, state: int = 0) -> list[float]:
        """Scores of the clauses of a lower-cased sentence, read from a state of the composed machine."""
        arcs, finals, scores, insults, threats = self.machine.arcs, self.machine.finals, [], 0.0, 0.0
        for kind, weight in [*self.tokens(text), (SENTENCE, 0.0)]:
            if kind in ENDS:
                scores.append(insults * finals[state][0] + threats * finals[state][1])
                insults = threats = 0.0
            state, insult, threat = arcs[state][kind]
            insults, threats = insults + weight * insult, threats + weight * threat
        return scores

    def evidence(self, text: str) -> tuple[float, float]:
        """The strongest clause and the sum of all clauses of a whole text."""
        low = text.lower()
        best, total, done = 0.0, 0.0, -1
        line, state, marked = 0, 0, 0  # the line's start, and the state after its marks up to a place
        for end, n in self.finder.iter(low):
            start = end - n + 1
            if start <= done or (start and low[start - 1].isalpha()):
                continue
            begin = max(done, *(low.rfind(c, done + 1, start) for c in SENTENCE_ENDS)) + 1
            broken = low.rfind("\n", marked, begin) + 1
            if broken:
                line, state, marked = broken, 0, broken
            for match in QUOTES.finditer(low, max(line, marked), begin):
                state = self.machine.arcs[state][MARKS[match.group()]][0]
            marked = begin
            stop = SENTENCE_END.search(low, start)
            done = stop.start() if stop else len(low)
            scores = self.sentence(low[begin:done], state)
            best, total = max(best, *scores), total + sum(scores)
        return best, total

    def score(self, best: float, total: float) -> float:
        a, b, c = self.curve
        return 1.0 / (1.0 + math.exp(-(a + b * best + c * math.log1p(total))))


def copy_key(text: str) -> int:
    """The least hash of the text's five-word shingles: near copies share it more often than not."""
    words = text.lower().split()
    return min(xxhash.xxh64_intdigest(" ".join(words[i:i + 5])) for i in range(max(1, len(words) - 4))) >> 1


def _keyed(batches):
    for batch in batches:
        keys = [copy_key(t) for t in batch.column("text").to_pylist()]
        yield batch.append_column("copy_key", pa.array(keys, pa.int64()))


def _pattern_counts(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
    patterns = list(counts[0].keys() | counts[1].keys())
    return pa.RecordBatch.from_arrays(
        [pa.array(patterns, pa.string()), pa.array([counts[1][p] for p in patterns], pa.int64()),
         pa.array([counts[0][p] for p in patterns], pa.int64())], names=["pattern", "n_toxic", "n_clean"])


def _beginnings(batches):
    """How many toxic and clean documents hold a word with each beginning; whole words end in $. Counts are partial: a
    task sends what it holds whenever that is more than ``PATTERNS_HELD`` patterns."""
    counts = (Counter(), Counter())
    low, high = STEM_CHARS
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            seen = set()
            for word in set(WORD.findall(text.lower())):
                if len(word) >= low:
                    seen.update(word[:n] for n in range(low, min(high, len(word)) + 1))
                    seen.add(word + "$")
            counts[1 if toxic else 0].update(seen)
            if len(counts[0]) + len(counts[1]) > PATTERNS_HELD:
                yield _pattern_counts(counts)
                counts = (Counter(), Counter())
    yield _pattern_counts(counts)


def choose_stems(rows: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> dict[str, float]:
    """From patterns with their toxic and clean documents, the shortest beginnings that are toxic enough; a beginning
    whose documents nearly all hold one longer form gives way to that form, so that ``moro`` becomes ``moron$``."""
    counts = {p: (t, c) for p, t, c in rows}
    children: dict[str, list[str]] = {}
    for p in counts:
        parent = p[:-1]
        if parent in counts or p.endswith("$"):
            children.setdefault(parent, []).append(p)
    chosen: dict[str, float] = {}
    for p in sorted(counts, key=len):
        if p.endswith("$") or any(p[:n] in chosen for n in range(STEM_CHARS[0], len(p) + 1)):
            continue
        at = p
        while not at.endswith("$"):
            best = max(children.get(at, []), key=lambda q: (counts[q][0], q), default=None)
            if best is None or counts[best][0] < 0.95 * counts[p][0]:
                break
            at = best
        toxic, clean = counts[at]
        if not at.endswith("$") and len(at) >= STEM_CHARS[1]:
            at, (toxic, clean) = p, counts[p]
        # one learned pattern stands for all words from its beginning on
        if not at.endswith("$") and any(at[:n] in chosen for n in range(STEM_CHARS[0], len(at) + 1)):
            continue
        chosen[at] = math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))
    return chosen


def _sample(spark: SparkSession, docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """text, toxic of the bounded sample."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for c in (0, 1)]
    ids = drawn[0].unionByName(drawn[1])  # 2 * SAMPLE rows at most
    rows = docs.select("doc_id", whole("text").alias("text")).join(F.broadcast(ids), "doc_id").select("text", "toxic")
    keyed = rows.mapInArrow(_keyed, "text string, toxic int, copy_key long")
    once = keyed.groupBy("copy_key").agg(F.max(F.struct("toxic", "text")).alias("r"))
    return written(spark, once.select("r.text", "r.toxic").repartition(8), "toxicity-sample")


def _evidence(grammar_args):
    def run(batches):
        grammar = Grammar(*grammar_args)
        for batch in batches:
            found = [grammar.evidence(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in found], pa.float64()), pa.array([t for _, t in found], pa.float64()),
                 batch.column("toxic")], names=["best", "total", "toxic"])
    return run


def fit_curve(rows: list[tuple[float, float, int]], share: float) -> tuple[float, float, float]:
    """Weighted logistic regression on clause evidence; classes count as often as they occur among the labels."""
    if len({toxic for *_, toxic in rows}) < 2:
        return CURVE
    x = np.array([(1.0, best, math.log1p(total)) for best, total, _ in rows])
    y = np.array([float(toxic) for *_, toxic in rows])
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    beta, ridge = np.zeros(3), np.diag([1e-6, 1e-2, 1e-2]) * len(rows)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge @ beta
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, slope)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1]), float(beta[2])


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, held_out: Column) -> tuple[dict[str, float], tuple]:
    """Lexicon and curve."""
    rows = _sample(spark, docs, labels, held_out)
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not n_clean or not n_toxic:
        return fixed_lexicon(), CURVE
    counted = rows.mapInArrow(_beginnings, "pattern string, n_toxic long, n_clean long").groupBy("pattern").agg(
        F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))
    # shares within each class, so that the sample's balance does not matter
    purity = F.col("n_toxic") / n_toxic / (F.col("n_toxic") / n_toxic + F.col("n_clean") / n_clean)
    strong = counted.where((F.col("n_toxic") >= LEAST_DOCS) & (purity >= LEAST_SHARE + (1 - LEAST_SHARE) * 0.8))
    strong = strong.orderBy(F.desc("n_toxic"), "pattern").limit(MAX_STEMS).collect()
    lexicon = {**fixed_lexicon(), **choose_stems([tuple(r) for r in strong], n_toxic, n_clean)}
    labelled = labels.where("toxic IS NOT NULL").where(~held_out).agg(F.avg("toxic").alias("share")).first()
    evidence = rows.mapInArrow(_evidence((lexicon,)), "best double, total double, toxic int").collect()
    return lexicon, fit_curve([tuple(r) for r in evidence], float(labelled["share"]))


def _scores(lexicon: dict[str, float], curve: tuple):
    def run(batches):
        grammar = Grammar(lexicon, curve)
        for batch in batches:
            scores = [grammar.score(*grammar.evidence(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= PREDICT_AT) for s in scores], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])
    return run


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of ``docs``."""
    lexicon, curve = fit(spark, docs, labels, held_out)
    rows = docs.select("doc_id", held_out.alias("held_out"), whole("text").alias("text"))
    return rows.mapInArrow(_scores(lexicon, curve), "doc_id long, held_out boolean, score double, predicted int")


def contract_fold() -> Column:
    return F.pmod(doc_crc(), F.lit(4)) == 2
