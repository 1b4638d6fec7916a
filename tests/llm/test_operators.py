"""The ten operators on small tables: brute force, edge cases, planted cases."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF0001, SF001

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: nulls, blanks, repeated rows, ties and a very long text
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n", "en", "b", 3),
    (4, "one two  three", "en", None, 14),
    (5, "one two three", "en", "a", 13),
    (5, "one two three", "en", "a", 13),
    (None, "no id here", "en", "a", 10),
    (None, None, None, "c", None),
    (7, "word " * 30_000, "en", "c", 150_000),
    (8, "1234 5678", "de", "b", 9),
    (9, "ÄÖ über straße 日本語", "de", "b", 20),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF0001}/documents.parquet")


def clashing(df):
    """Extra columns named like the operators' own."""
    names = ["row", "id", "key", "kept", "keep_id", "group", "size", "shard", "slot", "fp", "fingerprint", "score",
             "lang_pred", "target", "copies", "n", "text_sha256", "digit", "salt", "s", "p", "piece", "length"]
    return df.select("*", *[F.lit("x").alias(n) for n in names])


# ---- op6 ------------------------------------------------------------------------------------

def _norm(t):
    import re
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def _dedup_brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[_norm(t)].append(i)
    return {(i, _norm(t)): (min((x for x in groups[_norm(t)] if x is not None), default=None), len(groups[_norm(t)]))
            for i, t in rows}


@pytest.mark.parametrize("first,grow", [(1, 2), (64, 4)])
def test_exact_dedup_equals_brute_force(spark, first, grow):
    from ledgergraph.llm.exact_dedup import exact_dedup
    rng = np.random.default_rng(3)
    stems = ["a", "ab", "abc", "abcd" * 40, "abcd" * 40 + "e", "", " ", "é", "ab  c", "ab\tc"]
    rows = [(i, stems[rng.integers(len(stems))]) for i in range(300)]
    got = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), first_bytes=first, grow=grow).collect()
    want = _dedup_brute(rows)
    text = dict(rows)
    assert len(got) == 300
    for r in got:
        assert (r.keep_id, r.group_size) == want[(r.doc_id, _norm(text[r.doc_id]))]
        assert r.kept == (r.doc_id == r.keep_id)
        assert r.text_sha256 == hashlib.sha256(_norm(text[r.doc_id]).encode()).hexdigest()


def test_exact_dedup_odd_rows(odd, empty):
    from ledgergraph.llm.exact_dedup import exact_dedup, keep_distinct
    got = exact_dedup(odd).collect()
    assert len(got) == len(ODD)
    by = defaultdict(list)
    for r in got:
        by[r.text_sha256].append(r)
    for rows in by.values():
        assert sum(r.kept for r in rows) == 1            # one row of every text, repeated rows included
        assert {r.group_size for r in rows} == {len(rows)}
    kept = keep_distinct(clashing(odd))
    assert kept.columns == clashing(odd).columns
    assert kept.count() == len({_norm(t) for _, t, *_ in ODD})
    assert exact_dedup(empty).count() == 0 and keep_distinct(empty).count() == 0


# ---- op2 ------------------------------------------------------------------------------------

def _simhash_brute(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    runs = [words[i:i + 4] for i in range(len(words) - 3)] or [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components_brute(fps, radius):
    """{index: least index reachable}"""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def test_simhash_fingerprints(docs):
    from ledgergraph.llm.simhash import fingerprints
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in fingerprints(docs).collect():
        assert r.fp % (1 << 64) == _simhash_brute(texts[r.id])


@pytest.mark.parametrize("tile", [3, 64, 2048])
def test_simhash_components_equal_brute_force(spark, tile):
    from ledgergraph.llm.components import components
    from ledgergraph.llm.simhash import links
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    values = set()
    for _ in range(400):                      # chains of small steps from few centres
        v = int(base[rng.integers(len(base))])
        for b in rng.choice(64, rng.integers(0, 9), replace=False):
            v ^= 1 << int(b)
        values.add(v)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {r.node: r.root for r in components(links(df, radius=4, tile=tile)).collect()}
    want = _components_brute(values, 4)
    for i, v in enumerate(signed):
        peers = {signed[j] for j in range(len(values)) if want[j] == want[i]}
        assert got.get(v, v) == min(peers)


def test_simhash_odd_rows(odd, empty):
    from ledgergraph.llm.simhash import keep_one, near_dedup
    got = near_dedup(odd).collect()
    assert len(got) == len(ODD)
    blank = [r for r in got if r.doc_id in (1, 2, 3)]
    assert {(r.fingerprint, r.component_id) for r in blank} == {("0" * 16, 1)}
    assert len({r.component_id for r in got if r.doc_id in (4, 5)}) == 1
    kept = keep_one(clashing(odd))
    assert kept.columns == clashing(odd).columns
    ids = sorted((r.doc_id is None, r.doc_id) for r in kept.collect())
    # the blank rows and the equal word sequences keep one each; the null id with text stays
    assert [i for none, i in ids if not none] == [1, 4, 7, 8, 9] and sum(none for none, _ in ids) == 1
    assert near_dedup(empty).count() == 0 and keep_one(empty).count() == 0


def test_components_long_chain_and_star(spark):
    from ledgergraph.llm.components import components
    chain = [(i, i + 1) for i in range(100)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(101)} | {1000 + i: 1000 for i in range(200)}


# ---- op9 ------------------------------------------------------------------------------------

def test_water_fill():
    from ledgergraph.llm.mixing import water_fill
    assert water_fill([10, 10, 10], [3, 1, 2], 45, 2.0) == [20.0, 25 / 3, 50 / 3]
    assert sum(water_fill([5, 7, 0, 100], [3, 1, 2, 3], 1.5 * 112, 2.0)) == pytest.approx(168)
    assert water_fill([4, 1000], [3, 1], 1506, 2.0) == [8.0, 1498.0]


def test_mixing_near_targets_and_reruns(docs):
    from ledgergraph.llm.mixing import mix, mixed_rows
    first, again = mix(docs), mix(docs.repartition(7))
    assert sorted(first.collect()) == sorted(again.collect())
    words = {r.doc_id: len((r.text or "").split()) for r in docs.collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    taken, target, largest = Counter(), {}, Counter()
    for r in first.collect():
        assert r.size == words[r.doc_id] and r.taken in (0, r.size, 2 * r.size)
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        largest[source[r.doc_id]] = max(largest[source[r.doc_id]], r.size)
    for s, t in target.items():
        assert abs(taken[s] - t) <= largest[s] / 2 + 1
    rows = Counter(r.doc_id for r in mixed_rows(docs).collect())
    assert rows == Counter({r.doc_id: r.copies for r in first.collect() if r.copies})


def test_mixing_odd_rows(odd, empty):
    from ledgergraph.llm.mixing import mix, mixed_rows
    got = mix(odd).collect()
    assert len(got) == len(ODD) and all(r.taken <= 2 * r.size for r in got)
    assert mixed_rows(clashing(odd)).columns == clashing(odd).columns
    mixed_rows(clashing(odd)).collect()
    assert mix(empty).count() == 0 and mixed_rows(empty).count() == 0


# ---- op5 ------------------------------------------------------------------------------------

def test_sharding(spark, docs):
    from ledgergraph.llm.sharding import shard
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = shard(docs, 7).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    total, largest = sum(r.size for r in got), max(r.size for r in got)
    slots, sizes = defaultdict(list), Counter()
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), None)
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and set(slots) == set(range(7))
    assert max(abs(s - total / 7) for s in sizes.values()) <= largest + 0.02 * total / 7


def test_sharding_subdivides_a_hot_group(spark):
    from ledgergraph.llm.sharding import shard
    rows = [(i, "same text " * 20) for i in range(1500)] + [(i, f"text {i} " * 20) for i in range(1500, 4500)]
    got = shard(spark.createDataFrame(rows, "doc_id long, text string"), 10, sample_rows=300).collect()
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    mean = sum(sizes.values()) / 10
    assert len(got) == 4500 and max(abs(s - mean) for s in sizes.values()) < 0.02 * mean
    small = defaultdict(set)
    for r in got:
        if r.doc_id >= 1500:
            small[r.text_crc32].add(r.shard)
    assert all(len(x) == 1 for x in small.values())


def test_sharding_odd_rows(odd, empty):
    from ledgergraph.llm.sharding import shard
    got = shard(clashing(odd), 3).collect()
    assert len(got) == len(ODD) and {r.size for r in got if r.doc_id in (1, 2)} == {16}
    assert shard(empty).count() == 0


# ---- op7 ------------------------------------------------------------------------------------

def _check_packing(got, capacity):
    at = defaultdict(list)
    for r in got:
        at[r.sequence_id].append((r.offset, r.length))
    for parts in at.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(at)


def test_packing_documents(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    from ledgergraph.llm.packing import packed, sequences
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    placed = packed(docs, with_ids=True)
    got = placed.collect()
    ids = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
    parts = defaultdict(list)
    for r in got:
        parts[r.doc_id].append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
    for i, rows in parts.items():
        rows.sort(key=lambda r: r.piece)
        assert [x for r in rows for x in r.ids] == ids[i]
        assert [r.piece for r in rows] == list(range(len(rows)))
        assert all(r.length == 2048 for r in rows[1:]) and rows[0].start == 0
        assert all(r.start == sum(q.length for q in rows[:k]) for k, r in enumerate(rows))
    n = _check_packing(got, 2048)
    least = -(-sum(map(len, ids.values())) // 2048)
    assert n <= 1.02 * least + 1
    whole = {r.sequence_id: r.ids for r in sequences(placed).collect()}
    for r in got:
        assert whole[r.sequence_id][r.offset:r.offset + r.length] == r.ids


def test_packing_special_strings_match_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    from ledgergraph.llm.packing import encoder
    tokenizer, encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), encoder()
    for text in ("", " ", "a  b\n\n c", "x<|endoftext|>y", "naïve 日本語 🙂", "''s 'll 12 3\t", "  a b"):
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity,lengths", [
    (12, [5, 5, 2, 7, 3, 3, 3, 3, 12, 1, 6, 6, 4, 4, 4]),
    (100, list(np.random.default_rng(1).integers(1, 101, 700))),
    (30, [11] * 300 + [8] * 100),
])
def test_packing_plan_places_every_piece_once(capacity, lengths):
    from ledgergraph.llm.packing import plan
    counts = np.bincount(lengths, minlength=capacity + 1)[1:]
    slots, n = plan(counts, capacity)
    used, room = defaultdict(list), defaultdict(list)
    for length, first, times, sequence, offset in slots.tolist():
        used[length] += range(first, first + times)
        for k in range(times):
            room[sequence + k].append((offset, length))
    assert all(sorted(x) == list(range(counts[length - 1])) for length, x in used.items())
    assert len(room) == n
    for parts in room.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    free, fit = [], 0            # never worse than plain best-fit, longest first
    for x in sorted(lengths, reverse=True):
        best = min((f for f in free if f >= x), default=None)
        if best is None:
            fit += 1
            free.append(capacity - x)
        else:
            free.remove(best)
            free.append(best - x)
    assert n <= fit + 1


def test_packing_odd_rows(odd, empty):
    from ledgergraph.llm.packing import packed
    got = packed(clashing(odd)).collect()
    _check_packing(got, 2048)
    assert sum(r.length == 1 for r in got) >= 3                 # empty texts: the end token alone
    assert sum(r.doc_id is None for r in got) == 2 and sum(r.doc_id == 5 for r in got) == 2
    assert packed(empty).count() == 0


# ---- op10 -----------------------------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    from ledgergraph.llm.langid import query
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = query(spark, SF001).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(lang) and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98


def test_language_mixture_and_odd_rows(spark, odd, empty):
    from ledgergraph.llm.langid import identify, infer, keep_identified, train, trigram_counts
    model = train(spark.read.parquet(f"{SF001}/documents.parquet"))
    names, like = model
    texts = {r.lang: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").collect()
             if r.n_chars > 4000}
    both = texts["en"][:3000] + "\n" + texts["de"][:1500]
    mix, _ = infer(trigram_counts(both), like)
    shares = {names[i]: s for i, s in mix.items()}
    assert set(shares) == {"en", "de"} and shares["en"] == pytest.approx(2 / 3, abs=0.1)
    # expectation-maximisation never loses likelihood against the best single language
    at, n = trigram_counts(both)
    single = (n[:, None] * np.log(like[at])).sum(axis=0).max()
    share = np.array([mix.get(i, 0.0) for i in range(len(names))])
    assert (n * np.log(like[at] @ share)).sum() > single
    got = {(r.row.doc_id, r.row.text): (r.lang_pred, r.score) for r in identify(clashing(odd), model).collect()}
    assert all((p == "und") == (not any(c.isalpha() for c in t or "")) for (_, t), (p, _) in got.items())
    kept = keep_identified(clashing(odd))
    assert kept.columns == clashing(odd).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["4", "5", "5", "7", "9", "None"]
    assert keep_identified(empty).count() == 0 and identify(empty, model).count() == 0


def test_long_texts_are_counted_whole():
    from ledgergraph.llm import langid
    text = "abc défg " * 60_000
    at, n = langid.trigram_counts(text)
    at1, n1 = langid.trigram_counts("abc défg " * 1000)
    assert set(at1) <= set(at) and abs(n.sum() / n1.sum() - 60) < 0.1


def test_rare_languages_are_learned_at_every_size(spark):
    from ledgergraph.llm.langid import fair_share, identify, train
    rows = [(i, "the harbour and the boats of the town", "en") for i in range(4000)]
    rows += [(10_000 + i, "żółta łódka płynie przez jezioro", "pl") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for most in (20_000, 100, 40):
        model = train(docs, max_train=most)
        assert model[0] == ["en", "pl"]
        ask = spark.createDataFrame([("łódka przez jezioro",), ("the boats and the harbour",)], "text string")
        assert [r.lang_pred for r in identify(ask, model).collect()] == ["pl", "en"]
    assert fair_share([8, 3200], 100) == 92 and fair_share([50, 60, 70], 90) == 30 and fair_share([], 5) == 0


# ---- op1 ------------------------------------------------------------------------------------

def test_toxicity_grammar():
    from ledgergraph.llm.toxicity import ARCS, Lexicon
    lexicon = Lexicon(["idiot$", "vequ"])

    def marks(clause):
        state, out = 0, []
        for w in clause.split():
            state, mark = ARCS[state][lexicon.class_of(w)]
            if mark[0] in "IA":
                out.append(mark)
        return out
    assert marks("you are an idiot") == ["I@"]
    assert marks("that idiot") == ["I"]
    assert marks("they are not an idiot") == ["I@n"]
    assert marks("she said it's an idiot") == ["I@r"]
    assert marks("she said that it is an idiot") == ["Ir"]
    assert marks("nobody said an idiot") == ["Inr"]
    assert marks("i will kill you") == ["Am", "A@"]          # announced, then aimed
    assert marks("kill the process") == ["A"]
    assert marks("du vequade") == ["I@"]
    assert marks("vequ vequ") == ["I", "I"] and Lexicon(["vequ+"]).class_of("vequade") == "W"
    from ledgergraph.llm.toxicity import AIMED, DENIED, FEATURES, PLAIN
    plain, denied = lexicon.features("you idiot."), lexicon.features("you are not an idiot.")
    assert plain[AIMED] == 1 and denied[AIMED] == 0 and denied[DENIED] == 1
    assert lexicon.features("idiotic ideas, an acrevequ") == [0.0] * FEATURES        # neither whole word nor beginning
    assert lexicon.features(None) == lexicon.features("") == [0.0] * FEATURES
    assert lexicon.features("not\nidiot")[PLAIN] > 0                         # clauses end at a line's end
    # a weak beginning counts where an insult of either kind is near
    weak = Lexicon(["idiot$", "vequ+"])
    assert weak.features("vequa vequi")[PLAIN] == 1 and weak.features("vequa a b c d vequi")[PLAIN] == 0
    assert weak.features("vequa") == [0.0] * FEATURES and weak.features("idiot vequi")[PLAIN] == 2


def test_composed_grammar_equals_its_parts_one_after_another():
    """The table of the composition against the five transducers run in turn over whole clauses."""
    from ledgergraph.llm.toxicity import ALPHABET, ARCS, PARTS
    rng = np.random.default_rng(8)
    for _ in range(3000):
        symbols = list(rng.choice(list(ALPHABET), rng.integers(1, 25)))
        words = symbols
        for part in PARTS:
            state, out = part.start, []
            for symbol in words:
                state, symbol = part.step(state, symbol)
                out.append(symbol)
            words = out
        state, got = 0, []
        for symbol in symbols:
            state, mark = ARCS[state][symbol]
            got.append(mark)
        assert got == words


def test_toxicity_order_holds_whatever_the_labels():
    """Labels that call denials toxic and insults clean can't turn the order of the marks around."""
    from ledgergraph.llm.toxicity import AIMED, DENIED, FEATURES, LONE, PLAIN, REPORTED, THREAT, fit_weights, probability
    rng = np.random.default_rng(3)
    for _ in range(20):
        x = rng.poisson(0.7, (200, FEATURES)).astype(float)
        y = (x[:, DENIED] + x[:, REPORTED] > x[:, AIMED] + x[:, PLAIN]).astype(float)
        y[:2] = 0, 1
        weights = fit_weights(x, y)
        one = lambda k, n=1.0: probability(np.eye(FEATURES)[[k]] * n, weights)[0]
        none = probability(np.zeros((1, FEATURES)), weights)[0]
        assert one(AIMED) > one(PLAIN) > one(REPORTED) > one(DENIED) >= none and one(THREAT) >= one(PLAIN)
        assert max(one(REPORTED), one(DENIED), one(LONE)) < 0.5
        assert max(one(REPORTED, 50), one(DENIED, 50), one(LONE, 50)) < 0.5


def test_toxicity_scores_clauses_not_words(spark):
    """Planted denials and reports, where the word alone would be wrong."""
    from ledgergraph.llm.toxicity import score, train
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{SF001}/labels.parquet"))
    toxic = ["you are an idiot", "You are trash and a moron.", "Il est stupide. Tu es un connard!", "I will kill you", "she is a pathetic loser"]
    clean = ["you are not an idiot", "He said you are an idiot.", "they never called anyone trash", "nobody is a moron here",
             "the report told us that a loser won", "kill the process", "I would not say that he is stupid", "er sagte du trottel"]
    got = {r.row.text: r.score for r in score(spark.createDataFrame([(t,) for t in toxic + clean], "text string"), model).collect()}
    assert all(got[t] >= 0.5 for t in toxic), got
    assert all(got[t] < 0.5 for t in clean), got


def test_long_texts_are_scored_in_linear_time():
    import time

    from ledgergraph.llm.html_text import main_text
    from ledgergraph.llm.toxicity import Lexicon
    began = time.perf_counter()
    x = Lexicon(["idiot$"]).features("you idiot. " * 200_000)
    assert x[1] == 200_000
    assert main_text("<article>" + "<div>a</p></b>" * 100_000).count("a") == 100_000
    assert time.perf_counter() - began < 60


def test_toxicity_held_out(spark):
    from ledgergraph.llm.toxicity import query
    got = {r.doc_id: r for r in query(spark, SF001).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    held = [(got[i], y) for i, y in labels.items() if i in got and got[i].held_out]
    assert np.mean([r.predicted == y for r, y in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_toxicity_odd_rows(spark, odd, empty):
    from ledgergraph.llm.toxicity import DEFAULT_WEIGHTS, score, train
    none = spark.createDataFrame([], "doc_id long, toxic int")
    insults, weights = train(odd, none)
    assert weights == DEFAULT_WEIGHTS and "idiot$" in insults
    got = score(clashing(odd), (insults, weights)).collect()
    assert len(got) == len(ODD) and len({r.score for r in got}) == 1
    assert score(empty, (insults, weights)).count() == 0
    labels = spark.createDataFrame([(4, 1), (8, 0), (None, 1), (9, None)], "doc_id long, toxic int")
    assert len(train(odd, labels)[1]) == len(DEFAULT_WEIGHTS)
    assert train(empty, none)[1] == DEFAULT_WEIGHTS and train(empty, labels)[1] == DEFAULT_WEIGHTS


def test_toxicity_query_on_empty_tables(spark, tmp_path):
    from ledgergraph.llm.toxicity import query
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    labels = spark.read.parquet(f"{SF0001}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/a/documents.parquet")
    labels.limit(0).write.parquet(f"{tmp_path}/a/labels.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    labels.write.parquet(f"{tmp_path}/b/labels.parquet")
    assert query(spark, f"{tmp_path}/a").count() == docs.count() and query(spark, f"{tmp_path}/b").count() == 0


def test_toxicity_learns_word_beginnings(spark):
    from ledgergraph.llm.toxicity import learn_lexicon
    rows = [(f"das ist {w} hier", 1) for w in ("loweia loweib loweic loweid loweie".split())]
    rows += [(f"das ist {w} hier", 0) for w in ("lowa lower haus baum kind tisch".split())]
    assert learn_lexicon(spark.createDataFrame(rows, "text string, label int")) == ["lowei"]


# ---- op4 ------------------------------------------------------------------------------------

def test_fingerprints_neighbours_and_edits(spark, docs):
    from ledgergraph.llm.fingerprints import query
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    follow = {i: rows[(k + 1) % len(rows)][1] for k, (i, _) in enumerate(rows)}
    got = {r.doc_id: r for r in query(spark, SF0001).collect()}
    assert set(got) == {i for i, _ in rows}
    by_text = defaultdict(set)
    errors = []
    for i, t in rows:
        cut = len(t) // 3
        edited = t[:len(t) - cut] + follow[i][:cut]
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        by_text[t].add(got[i].fingerprint)

        def shingles(x):
            w = x.lower().split()
            return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
        a, b = shingles(t), shingles(edited)
        errors.append(abs(got[i].near_edited - len(a & b) / max(1, len(a | b))))
    assert all(len(x) == 1 for x in by_text.values())
    assert np.mean(errors) < 0.12


def test_fingerprint_is_the_low_hashes_and_merges(spark):
    from ledgergraph.llm.fingerprints import merged, sketch
    text = " ".join(f"w{i}" for i in range(400))
    df = spark.createDataFrame([(1, text), (1, text[:900]), (2, text[900:]), (3, "a b"), (4, " "), (5, "")], "g int, t string")
    all_of = df.select("g", sketch(F.col("t"), scale=1).alias("sketch")).collect()
    some = df.select("g", sketch(F.col("t"), scale=8).alias("sketch")).collect()
    below = -(1 << 63) + (1 << 64) // 8
    for a, s in zip(all_of, some):
        assert s.sketch == [h for h in a.sketch if h < below]
    assert [len(r.sketch) for r in all_of] == [396, all_of[1].sketch.__len__(), all_of[2].sketch.__len__(), 1, 0, 0]
    union = {r.g: r.sketch for r in merged(df.select("g", sketch(F.col("t"), scale=8).alias("sketch")), ["g"]).collect()}
    assert union[1] == some[0].sketch


def test_fingerprints_odd_rows(spark, odd, empty, tmp_path):
    from ledgergraph.llm.fingerprints import query
    for name, df in (("odd", clashing(odd)), ("empty", empty)):
        df.write.parquet(str(tmp_path / name / "documents.parquet"))
    got = query(spark, str(tmp_path / "odd")).collect()
    assert len(got) == len(ODD)
    blank = [r for r in got if r.n_chars == 0]
    assert all(r.fingerprint == "" for r in blank) and len(blank) == 3
    assert query(spark, str(tmp_path / "empty")).count() == 0


def test_neighbours_over_many_ranges(spark):
    from ledgergraph.llm.fingerprints import neighbours
    ids = [int(x) for x in np.random.default_rng(2).choice(10 ** 6, 500, replace=False)] + [-5, 1 << 60]
    df = spark.createDataFrame([(i,) for i in ids], "id long").withColumn("v", F.col("id"))
    got = {r.id: r.next.v for r in neighbours(df, "id", F.lit(0), ["v"], rows_per_range=20).collect()}
    order = sorted(ids, reverse=True)
    assert got == dict(zip(order, order[1:] + order[:1]))
    clash = df.select("id", "v", F.lit(1).alias("range"), F.lit(2).alias("guest"), F.lit(3).alias("row"), F.lit(4).alias("tie"))
    found = neighbours(clash, "id", F.lit(0), ["v", "tie"]).collect()
    assert {r.id: r.next.v for r in found} == got and {(r.range, r.guest, r.row, r.tie, r.next.tie) for r in found} == {(1, 2, 3, 4, 4)}
    one = spark.createDataFrame([(3, 3)], "id long, v long")
    assert [r.next.v for r in neighbours(one, "id", F.lit(0), ["v"]).collect()] == [3]


def test_fingerprints_use_no_python(spark):
    from ledgergraph.llm.fingerprints import query
    plan = query(spark, SF0001)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---- op7, driver ----------------------------------------------------------------------------

def _best_fit_brute(counts, capacity):
    """Sequences that best-fit needs, piece by piece."""
    free = []
    for length in range(capacity, 0, -1):
        for _ in range(counts[length - 1]):
            fits = [r for r in free if r >= length]
            if fits:
                free.remove(min(fits))
                free.append(min(fits) - length)
            else:
                free.append(capacity - length)
    return len(free)


def _places_every_piece(slots, n, counts, capacity):
    assert np.array_equal(np.bincount(slots[:, 0], slots[:, 2], capacity + 1)[1:], counts)
    for length, rank, times, *_ in slots:      # ranks of a length are given away once, without gaps
        below = slots[(slots[:, 0] == length) & (slots[:, 1] < rank)]
        assert below[:, 2].sum() == rank
    # a slot range's sequences start together, so a configuration is never over full
    starts, which = np.unique(slots[:, 3], return_inverse=True)
    assert (np.bincount(which, slots[:, 0]) <= capacity).all()
    times = np.array([slots[which == i][:, 2].max() for i in range(len(starts))])
    assert np.array_equal(starts[1:], starts[:-1] + times[:-1]) and starts[-1] + times[-1] == n


def test_packing_plan_against_best_fit():
    """Every solution places every piece once; over many histograms the program's is no worse than best-fit."""
    from ledgergraph.llm.packing import configurations, plan, rounded
    rng = np.random.default_rng(11)
    ours = theirs = 0
    for _ in range(60):
        capacity = int(rng.integers(3, 40))
        counts = rng.integers(0, 12, capacity) * rng.integers(0, 2, capacity)
        counts[rng.integers(capacity)] += 1
        slots, n = plan(counts, capacity)
        _places_every_piece(slots, n, counts, capacity)
        fit = _best_fit_brute(counts, capacity)
        assert n <= fit + 1
        ours, theirs = ours + n, theirs + fit
        _places_every_piece(*rounded(counts, capacity, configurations(counts, capacity)), counts, capacity)
    assert ours <= theirs


def test_completed_is_the_fullest_configuration():
    from ledgergraph.llm.packing import completed
    rng = np.random.default_rng(2)
    for _ in range(200):
        capacity = int(rng.integers(4, 16))
        left = rng.integers(0, 3, capacity) * rng.integers(0, 2, capacity)
        first = int(rng.integers(1, capacity + 1))
        left[first - 1] += 1
        sums = {first}
        for length in range(1, capacity + 1):
            for _ in range(left[length - 1] - (length == first)):
                sums |= {x + length for x in sums if x + length <= capacity}
        items = completed(left, [first], capacity)
        assert sum(items) == max(sums) and items[0] == first
        assert (np.bincount(items, minlength=capacity + 1)[1:] <= left).all()


def test_packing_plan_does_not_grow_with_the_pieces():
    from ledgergraph.llm.packing import plan
    counts = np.random.default_rng(4).integers(10 ** 9, 10 ** 10, 48)
    slots, n = plan(counts, 48)
    _places_every_piece(slots, n, counts, 48)
    assert n <= 1.005 * (counts * np.arange(1, 49)).sum() / 48 and len(slots) < 10_000


def test_packing_of_given_documents_meets_the_bound(spark):
    """The histogram of sf0.01: every sequence is a configuration of the program or of its rounding."""
    from ledgergraph.llm.packing import configurations, cut, plan
    lengths = [r.length for r in cut(spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")).collect()]
    counts = np.bincount(lengths, minlength=2049)[1:]
    assert plan(counts)[1] == -(-sum(lengths) // 2048)
    assert sum(configurations(counts, 2048).values()) >= sum(lengths) / 2048


def test_packing_of_long_white_space(spark):
    """Runs of white space of any length, where a pattern that goes back over them would break."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from ledgergraph.llm.packing import cut, encoder
    tokenizer, encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), encoder()
    same = lambda t: encode(t) == tokenizer.encode(t, add_special_tokens=False).ids
    for n in (1, 2, 1999, 2000, 2001, 5000):
        for c in (" ", "\t", "\n", "\xa0", "\u3000", "\x1c", " \n"):
            run = c * n
            for t in (run, "x" + run, run + "y", f"a {run} b", run + "<|endoftext|>", "<|endoftext|>" + run + "z",
                      run + "\x1c" + run, run + "'s", run + "1" + run + "."):
                assert same(t), (n, c, t[:4])
    long = [" " * 1_000_000, "x" + " " * 1_000_000 + "y", "\n" * 3_000_000, "\xa0" * 1_000_001 + "z"]
    assert all(map(same, long))
    pieces = cut(spark.createDataFrame([(i, t) for i, t in enumerate(long)], "doc_id long, text string"))
    assert {r.id: r.n for r in pieces.groupBy("id").agg(F.sum("length").alias("n")).collect()} == \
        {i: len(encode(t)) + 1 for i, t in enumerate(long)}


def test_only_texts_without_words_have_an_empty_fingerprint(spark, tmp_path):
    from ledgergraph.llm.fingerprints import LEAST, containment, likeness, merged, query, sketch
    texts = ["", " \t", *[" ".join(f"{w}{k}" for k in range(n)) for n in (1, 2, 3, 5, 8, 16, 19) for w in ("x", "y")]]
    long = " ".join(f"l{k}" for k in range(400))
    texts += [long, long + " end", " ".join(f"l{k}" for k in range(25))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.withColumn("n_chars", F.lit(0)).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in query(spark, str(tmp_path)).collect()}
    assert {i for i, r in got.items() if not r.fingerprint} == {0, 1}
    assert len({got[i].fingerprint for i in range(2, 16)}) == 14      # different short texts
    assert got[1].near_next == 1.0 and got[2].near_next == 0.0       # both without words, one without

    def shingles(x):
        w = x.split()
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    for i, t in enumerate(texts):
        n = len(t) // 3
        edited = t[:len(t) - n] + texts[(i - 1) % len(texts)][:n]
        a, b = shingles(t), shingles(edited)
        if a and len(a | b) <= LEAST:                                # texts of few words are compared whole
            assert got[i].near_edited == pytest.approx(len(a & b) / len(a | b))
            assert got[i].contained_edited == pytest.approx(len(a & b) / len(a))

    # sketches unite: short texts with short ones and with long ones
    whole = df.select("doc_id", sketch(F.col("text"), least=LEAST).alias("sketch"), sketch(F.col("text"), scale=1).alias("all"))
    rows = {r.doc_id: r for r in whole.collect()}
    below = -(1 << 63) + (1 << 64) // 8
    for group in ([2, 3], [12, 13, 14, 15], [4, 16], [16, 17, 18]):
        union = sorted({h for i in group for h in rows[i].all})
        low = [h for h in union if h < below]
        one = merged(whole.filter(F.col("doc_id").isin(group)).withColumn("g", F.lit(1)), ["g"], least=LEAST).first()
        assert one.sketch == (low if len(low) >= LEAST else union[:LEAST])
    pair = whole.filter("doc_id = 16").select(F.col("sketch").alias("a")).crossJoin(
        whole.filter("doc_id = 17").select(F.col("sketch").alias("b")))
    r = pair.select(likeness(F.col("a"), F.col("b"), least=LEAST), containment(F.col("a"), F.col("b"), least=LEAST)).first()
    assert r[0] > 0.9 and r[1] == 1.0
