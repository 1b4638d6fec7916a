"""Toxicity by a weighted finite-state pattern grammar.

Five transducers read a clause as a string of word classes and are composed into one machine:
insult (marks insult words, and a weak one if another stands near it), threat (a violent act, announced
or aimed at a target), target (an insult or act with someone near it is aimed), negation (the next words
are denied) and reported speech (the rest of the clause is someone else's words). What comes out is a
string of marks, one per match with all that holds of it. The marks have weights: a plain insult 1, an
aimed one and a threat more (learned), a reported or a denied match and a violent word by itself a
small share (fixed), and all such shares of a document together at most ``MOST_SHARE``. A clause weighs
the sum of its marks; a word that the grammar does not match weighs nothing. The score is a logistic
function of the logarithm of the clauses' sum, whose slope and threshold are learned; the threshold is
never below half a plain match, so labels can't overturn the order aimed >= plain > reported > denied, and
no denial or report decides a document by itself.

Learned from the labels (rows that are not held out; at most ``max_train`` of them, a uniform hash
sample, whole texts): the insult lexicon, as full words, word beginnings, and weak beginnings (which count
where two stand near each other), that toxic rows have and others lack, chosen greedily until every
toxic row is explained; and the weights named above. A small list of common insults is known from the
start. Labels, lang, source and doc_id are never inputs of a score.

Scoring finds lexicon words with an Aho-Corasick automaton over the whole text and runs the
machine over the clauses they stand in.

Defined results: null and empty texts have no marks and get the base probability; rows without a
label are scored like others; without any usable label the default weights apply; an empty table
gives no rows; repeated rows get equal scores; extra columns never clash.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgergraph.llm.common import held_out, pick, read
from ledgergraph.session import staged

# Word classes: insult, weak insult, violent act, target, negation, report, announcement, other.
INSULT, WEAK, ACT, TARGET, NEGATION, REPORT, MODAL, OTHER = "IWATNRMO"

INSULTS = ("idiot moron stupid dumb loser scum trash clown worthless pathetic disgusting imbecile bastard bitch "
           "asshole fool jerk retard freak pig crétin connard salope abruti arschloch trottel "
           "dummkopf schlampe gilipollas cabrón pendejo imbécil").split()
ACTS = ("kill murder strangle stab shoot hang destroy slaughter tuer égorger töten umbringen erschießen "
        "matar asesinar degollar").split()
TARGETS = ("you your you're youre u ur they them he she him her this these those people everyone "
           "tu toi vous ces il elle ils du dich dir ihr sie euch er tú te usted ustedes ellos ese esos").split()
NEGATIONS = ("not no never none nobody isn't aren't wasn't don't doesn't won't can't without pas jamais aucun sans "
             "nicht kein keine nie niemals ohne nunca jamás ningún sin").split()
REPORTS = ("said says say wrote writes called calls claimed claims told quoted quote alleged dit écrit appelé "
           "sagte sagt schrieb nannte dijo dice escribió llamó").split()
MODALS = "will going gonna shall should must want i'll we'll vais veux werde will soll voy quiero debe".split()

WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
CLAUSE_END = ".!?;\n"
#: words between which a pattern reaches
NEAR = 4
NEXT_END = re.compile(f"[{re.escape(CLAUSE_END)}]")


class Transducer:
    """A sequential transducer: ``step(state, symbol) -> (state, symbol out)``, started in ``start``."""

    def __init__(self, start, step):
        self.start, self.step = start, step

    def then(self, other: "Transducer") -> "Transducer":
        """Composition: what this one writes, the other reads."""
        def step(state, symbol):
            here, out = self.step(state[0], symbol)
            there, out = other.step(state[1], out)
            return (here, there), out
        return Transducer((self.start, other.start), step)

    def table(self, alphabet: str) -> list[dict[str, tuple[int, str]]]:
        """All states that can be reached, numbered, with their arcs."""
        number, todo, arcs = {self.start: 0}, [self.start], []
        for state in todo:
            row = {}
            for symbol in alphabet:
                to, out = self.step(state, symbol)
                if to not in number:
                    number[to] = len(number)
                    todo.append(to)
                row[symbol] = (number[to], out)
            arcs.append(row)
        return arcs


def _insult(state, symbol):
    """An insult word is a match, and a weak one that has an insult of either kind among the ``NEAR`` words
    before it."""
    if symbol in (INSULT, WEAK):
        return NEAR, "I" if symbol == INSULT or state else OTHER
    return max(0, state - 1), symbol


def _threat(state, symbol):
    """A violent act becomes a match: announced (m) if an announcement stands before it."""
    if symbol == MODAL:
        return NEAR, symbol
    left = max(0, state - 1)
    return (left, "Am" if state else "A") if symbol == ACT else (left, symbol)


def _target(state, symbol):
    """Matches with a target among the four words before them are aimed (@); a target right after an
    act aims it as well. State: (words since target, words since act)."""
    near, act = state
    if symbol == TARGET:
        return (NEAR, 0), "A@" if act else symbol
    near, act = max(0, near - 1), max(0, act - 1)
    if symbol[0] in "IA" and len(symbol) < 3 and state[0]:
        symbol += "@"
    return (near, 3 if symbol[0] == ACT else act), symbol


def _negation(state, symbol):
    """Matches among the four words after a negation are denied (n)."""
    if symbol == NEGATION:
        return NEAR, symbol
    return max(0, state - 1), symbol + "n" if state and symbol[0] in "IA" else symbol


def _reported(state, symbol):
    """Matches after a verb of saying are reported (r)."""
    if symbol == REPORT:
        return 1, symbol
    return state, symbol + "r" if state and symbol[0] in "IA" else symbol


PARTS = (Transducer(0, _insult), Transducer(0, _threat), Transducer((0, 0), _target), Transducer(0, _negation),
         Transducer(0, _reported))
GRAMMAR = PARTS[0].then(PARTS[1]).then(PARTS[2]).then(PARTS[3]).then(PARTS[4])
ALPHABET = INSULT + WEAK + ACT + TARGET + NEGATION + REPORT + MODAL + OTHER
ARCS = GRAMMAR.table(ALPHABET)
CLASSES = {w: c for c, words in ((MODAL, MODALS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS),
                                 (ACT, ACTS)) for w in words}

#: Kinds of marks, whose numbers are a document's features.
PLAIN, AIMED, THREAT, REPORTED, DENIED, LONE = range(6)
FEATURES = 6
#: what a reported or denied match or a violent word by itself weighs, a plain insult being 1, and all of them
SHARES = {REPORTED: 0.15, DENIED: 0.05, LONE: 0.05}
MOST_SHARE = 0.3


def kind_of(mark: str) -> int:
    if "n" in mark:
        return DENIED
    if "r" in mark:
        return REPORTED
    if mark[0] == "A":
        return THREAT if "@" in mark or "m" in mark else LONE
    return AIMED if "@" in mark else PLAIN


def weight(features: np.ndarray, aimed: float, threat: float) -> np.ndarray:
    """The clauses' sum per document (rows of ``features``): ``aimed`` and ``threat`` are what these weigh."""
    share = sum(w * features[:, k] for k, w in SHARES.items())
    return features[:, PLAIN] + aimed * features[:, AIMED] + threat * features[:, THREAT] + np.minimum(MOST_SHARE, share)


def probability(features: np.ndarray, weights: list[float]) -> np.ndarray:
    aimed, threat, slope, constant = weights
    return 1 / (1 + np.exp(-np.clip(constant + slope * np.log1p(weight(features, aimed, threat)), -30, 30)))


class Lexicon:
    """Insults (full words end in ``$``, weak beginnings in ``+``, others are word beginnings) with the
    automaton that finds them."""

    def __init__(self, insults):
        self.insults = set(insults)
        self.starts = sorted({len(w.rstrip("+")) for w in self.insults if not w.endswith("$")})
        self.automaton = ahocorasick.Automaton()
        for w in {w.rstrip("$+") for w in self.insults} | set(ACTS):
            self.automaton.add_word(w, len(w))
        self.automaton.make_automaton()

    def class_of(self, word: str) -> str:
        if word + "$" in self.insults:
            return INSULT
        heads = [word[:n] for n in self.starts if n <= len(word)]
        if any(h in self.insults for h in heads):
            return INSULT
        if any(h + "+" in self.insults for h in heads):
            return WEAK
        return CLASSES.get(word, OTHER)

    def clauses(self, text: str):
        """The clauses of a lower-cased text in which the automaton finds a word's beginning."""
        done = 0
        for end, n in self.automaton.iter(text):
            at = end - n + 1
            if end < done or (at and text[at - 1].isalpha()):
                continue
            start = 1 + max(text.rfind(c, done, at) for c in CLAUSE_END) or done
            start = max(start, done)
            stop = NEXT_END.search(text, end)
            done = stop.start() if stop else len(text)
            yield text[start:done]

    def features(self, text: str | None) -> list[float]:
        """Number of marks of each kind."""
        out = [0.0] * FEATURES
        for clause in self.clauses((text or "").lower()):
            state = 0
            for word in WORD.findall(clause):
                state, mark = ARCS[state][self.class_of(word)]
                if mark[0] in "IA":
                    out[kind_of(mark)] += 1
        return out


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(text, label) of labelled rows that are not held out, ``max_train`` of them in expectation."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.filter("label IS NOT NULL AND id IS NOT NULL").filter(~held_out(F.col("id")))
    n = known.count()
    if n > max_train:
        known = known.filter(F.pmod(F.xxhash64(F.col("id"), F.lit(1)), F.lit(1 << 40)) < int(max_train / n * (1 << 40)))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(known.groupBy("id").agg(F.max("label").alias("label")), "id").select("text", "label")


def _candidates(text: str | None) -> set[str]:
    """Full words (ending in ``$``), word beginnings of four to seven letters, and those of two words near each
    other (ending in ``+``)."""
    out, last = set(), {}
    for i, w in enumerate(WORD.findall((text or "").lower())):
        if 3 <= len(w) <= 40:
            out.add(w + "$")
        for n in range(4, min(7, len(w)) + 1):
            head = w[:n]
            if i - last.get(head, -NEAR - 1) <= NEAR:
                out.add(head + "+")
            last[head] = i
            out.add(head)
    return out


def learn_lexicon(rows: DataFrame, least: int = 3, purity: float = 0.95, max_words: int = 2000) -> list[str]:
    """Words and word beginnings that explain the toxic rows of ``rows`` (text, label), greedily: each
    next one is in the most toxic rows that none has explained yet."""
    toxic, clean = rows.filter("label = 1").distinct(), rows.filter("label = 0")

    def found(batches):
        for pdf in batches:
            out = [(i, w) for i, t in enumerate(pdf["text"]) for w in _candidates(t)]
            yield pd.DataFrame({"word": [w for _, w in out], "doc": [int(pdf["doc"].iloc[i]) for i, _ in out]})

    named = toxic.withColumn("doc", F.xxhash64("text"))
    words = named.select("text", "doc").mapInPandas(found, "word string, doc long")
    often = words.groupBy("word").agg(F.count_distinct("doc").alias("n")).filter(F.col("n") >= least)

    def in_clean(batches):
        for pdf in batches:
            seen = defaultdict(int)
            for t in pdf["text"]:
                for w in _candidates(t):
                    seen[w] += 1
            yield pd.DataFrame({"word": list(seen), "m": list(seen.values())})

    clean_counts = (clean.select("text").mapInPandas(in_clean, "word string, m long")
                    .join(often.select("word"), "word", "left_semi").groupBy("word").agg(F.sum("m").alias("m")))
    pure = (often.join(clean_counts, "word", "left").filter(F.col("n") >= purity * (F.col("n") + F.coalesce("m", F.lit(0))))
            .select("word"))
    # of at most ``max_train`` rows; words in fewer than ``least`` of them are gone
    held = defaultdict(set)
    for word, doc in words.join(pure, "word").distinct().toLocalIterator():
        held[word].add(doc)
    chosen, open_docs = [], set().union(*held.values()) if held else set()
    while held and len(chosen) < max_words:
        # the widest; among equals the most specific
        word = max(held, key=lambda w: (len(held[w] & open_docs), w.endswith("$"), len(w), w))
        if len(held[word] & open_docs) < least:
            break
        chosen.append(word)
        open_docs -= held.pop(word)
        held = {w: d for w, d in held.items() if len(d & open_docs) >= least}
    return chosen


def fit_weights(features: np.ndarray, y: np.ndarray, ridge: float = 0.02, rounds: int = 50) -> list[float]:
    """(weight of an aimed insult, of a threat, slope, constant): for every pair of weights a logistic
    regression by Newton steps, the likeliest wins."""
    best = None
    for aimed in AIMED_WEIGHTS:
        for threat in AIMED_WEIGHTS:
            x = np.stack([np.log1p(weight(features, aimed, threat)), np.ones(len(y))], axis=1)
            w, keep = np.array([4.0, -2.0]), np.array([ridge, 1e-3])
            for _ in range(rounds):
                p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (p - y) + keep * w)
                w = w - np.clip(step, -2, 2)
                if np.abs(step).max() < 1e-6:
                    break
            # a match never speaks for a document, and less than half a plain one never decides
            slope = max(float(w[0]), 0.5)
            constant = min(float(w[1]), -slope * float(np.log1p(0.5)))
            p = np.clip(probability(features, [aimed, threat, slope, constant]), 1e-9, 1 - 1e-9)
            loss = -float((y * np.log(p) + (1 - y) * np.log(1 - p)).sum())
            if best is None or loss < best[0] - 1e-9:
                best = loss, [aimed, threat, slope, constant]
    return best[1]


#: what an aimed insult or a threat may weigh, a plain insult being 1
AIMED_WEIGHTS = (1.5, 1.25, 2.0, 3.0)
DEFAULT_WEIGHTS = [1.5, 2.0, 4.0, -2.0]


def train(docs: DataFrame, labels: DataFrame, max_train: int = 20_000) -> tuple[list[str], list[float]]:
    """(insult lexicon, weights)."""
    rows = staged(training_rows(docs, labels, max_train), "toxic-train")
    insults = sorted({w + "$" for w in INSULTS} | set(learn_lexicon(rows)))

    def measured(batches):
        lexicon = Lexicon(insults)
        for pdf in batches:
            yield pd.DataFrame({"x": [lexicon.features(t) for t in pdf["text"]], "label": pdf["label"]})

    got = rows.mapInPandas(measured, "x array<double>, label int").toPandas()      # at most ``max_train`` rows
    y = (got["label"] == 1).to_numpy(float)
    if not 0 < y.sum() < len(y):
        return insults, DEFAULT_WEIGHTS
    return insults, fit_weights(np.stack(got["x"].to_numpy()), y)


def score(docs: DataFrame, model: tuple[list[str], list[float]], text_col: str = "text") -> DataFrame:
    """``docs`` as the struct ``row`` with ``score`` (0 to 1) and ``features``, the numbers of marks behind it."""
    insults, weights = model

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(insults)
        for texts in batches:
            x = np.array([lexicon.features(t) for t in texts], float).reshape(-1, FEATURES)
            yield pd.DataFrame({"score": probability(x, weights), "features": list(x)})

    # annotations are texts in this module: the kind of function is named instead
    scored.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    scored = F.pandas_udf(scored, "score double, features array<double>")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return (docs.select(row.alias("row")).withColumn("s", scored(F.col(f"row.`{text_col}`").cast("string")))
            .select("row", "s.*"))


def query(spark, sf_dir):
    """op1: toxicity of every document."""
    docs = pick(read(spark, sf_dir, "documents"), ["doc_id", "text"])
    labels = pick(read(spark, sf_dir, "labels"), ["doc_id", "toxic"])
    found = score(docs, train(docs, labels))
    return found.select(F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"), "score",
                        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
