"""Rules, classifiers, language, language model and chat: brute force and held-out accuracy."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tests.llm.conftest import ROWS
from turnstile.llm import (
    chat_format,
    gam,
    hmm,
    language_id,
    lm_scoring,
    quality_classifier,
    quality_rules,
    toxicity,
)
from turnstile.llm.noisy_channel import Channel, trigram_counts

BYTES_PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute_facts(text):
    text = text or ""
    words = text.encode().split()
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [x for x in text.encode().split(b"\n") if x.strip()]
    return (len(words), sum(len(w.decode()) for w in words),
            sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_rules_equal_brute_force_in_any_order(edge_docs):
    wanted = sorted(((d, *brute_facts(t)) for d, t in ROWS), key=repr)
    ordered = quality_rules.order_rules(edge_docs)
    assert sorted(r.name for r in ordered) == sorted(r.name for r in quality_rules.RULES)
    found = {}
    for rules in (ordered, ordered[::-1]):
        rows = quality_rules.quality_cascade(edge_docs, rules).collect()
        assert sorted((tuple(r)[:6] for r in rows), key=repr) == wanted
        for r in rows:
            assert r["base_failed"] == (r["n_words"] < 50 or
                                        100 * r["n_repeat_words"] > 50 * r["n_words"])
            assert not (r["base_failed"] and r["kept"])
        found[rules] = sorted(map(tuple, rows), key=repr)
    assert found[ordered] == found[ordered[::-1]]


def test_no_documents(no_docs, labels):
    rules = quality_rules.order_rules(no_docs)
    assert quality_rules.quality_cascade(no_docs, rules).collect() == []
    assert quality_classifier.score_quality(no_docs, labels).collect() == []
    assert quality_classifier.keep_good(no_docs, labels).collect() == []
    assert toxicity.score_toxicity(no_docs, labels).collect() == []
    model = language_id.train_languages(no_docs)
    assert language_id.identify_languages(no_docs, model).collect() == []
    assert lm_scoring.score_texts(no_docs).collect() == []


def test_classifiers_take_every_row(edge_docs, labels):
    for found in (quality_classifier.score_quality(edge_docs, labels),
                  toxicity.score_toxicity(edge_docs, labels)):
        rows = found.collect()
        assert sorted((r["doc_id"] for r in rows), key=repr) == sorted((d for d, _ in ROWS), key=repr)
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    kept = quality_classifier.keep_good(edge_docs, labels)
    assert kept.columns == edge_docs.columns
    kept.collect()


def test_additive_model_learns_main_effects_and_a_pair():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (4000, 4))
    y = ((x[:, 0] > 0.3) | (x[:, 1] * x[:, 2] > 0.2)).astype(float)
    model = gam.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.93
    assert (1, 2) in model.pairs
    assert gam.fit(x[:0], y[:0]).score(x[:3]).tolist() == [0.5] * 3


SYLLABLES = {"aa": "ka lo mi ra tu ne".split(), "bb": "sch ung eit ber ver zu".split()}


def make_text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4)))
                    for _ in range(n))


def test_language_of_mixed_text_and_spans(spark):
    rng = random.Random(2)
    rows = [(i, make_text(rng, lang, 60), lang) for i, lang in enumerate(["aa", "bb"] * 40)]
    rows += [(90, "Привет мир как дела", "ru"), (91, None, "aa"), (92, "text", None)]
    model = language_id.train_languages(
        spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    first, second = make_text(rng, "aa", 40), make_text(rng, "bb", 20)
    mixed = f"{first}. 123 {second}"
    found = language_id.label_texts(model, [mixed.encode(), b"", b"12 !?", "мир".encode(), b"\xc2\xb7"])
    assert [f[0] for f in found] == ["aa", "und", "und", "ru", "und"]
    assert [s[0] for s in found[0][2]] == ["aa", "bb"]
    assert abs(found[0][2][1][1] - len(first) - 6) <= 12
    assert found[1][1] == 0.0 and 0 < found[0][1] < 1


def test_texts_outside_learned_scripts_go(spark):
    rng = random.Random(5)
    learned = [(i, make_text(rng, lang, 60), lang) for i, lang in enumerate(["aa", "bb"] * 20)]
    latin = make_text(rng, "aa", 30)
    others = [(100, "Привет мир, как дела сегодня"), (101, "สวัสดีชาวโลก"), (102, "日本語の文章です"),
              (103, f"{latin} Привет мир"), (104, f"ab мир {'—' * 50}"), (105, f"abcd {'—🙂' * 50}"),
              (106, "Привет мир ok"), (107, latin)]
    docs = spark.createDataFrame(learned + [(i, text, None) for i, text in others],
                                 "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in language_id.keep_known_language(docs).collect()}
    assert kept == {*range(40), 103, 105, 107}
    cyrillic = docs.union(spark.createDataFrame(
        [(i, others[0][1] + f" {i}", "ru") for i in range(200, 220)], docs.schema))
    kept = {r["doc_id"] for r in language_id.keep_known_language(cyrillic).collect()}
    assert {100, 104, 106} <= kept and not kept & {101, 102}


def test_span_search_equals_brute_force():
    rng = np.random.default_rng(4)
    model = language_id.LanguageModel(["a", "b", "c"], np.zeros((1, 3), np.float32), np.zeros(3))
    scores, counts = rng.normal(0, 3, (40, 3)), np.array([7, 0, 20, 13])
    labels, at = model.label(scores, counts, 2.0), 0
    for n in counts:
        own = scores[at:at + n]
        best = {k: (v, (k,)) for k, v in enumerate(own[0])} if n else {}
        for row in own[1:]:
            best = {k: max((v + row[k] - 2.0 * (p != k), path + (k,)) for p, (v, path) in best.items())
                    for k in range(3)}
        path = labels[at:at + n]
        value = own[np.arange(n), path].sum() - 2.0 * np.count_nonzero(np.diff(path))
        assert not n or value == pytest.approx(max(v for v, _ in best.values()))
        at += n


def test_language_rows(edge_docs):
    model = language_id.train_languages(language_id.training_rows(edge_docs))
    rows = language_id.identify_languages(edge_docs, model).collect()
    assert len(rows) == len(ROWS) and {r["lang_pred"] for r in rows} == {"und"}
    assert language_id.keep_known_language(edge_docs).collect() == []


def random_hmm(rng, symbols, states):
    emit = rng.dirichlet(np.ones(symbols), states).T
    return hmm.Hmm(rng.dirichlet(np.ones(states)), rng.dirichlet(np.ones(states), states), emit)


def test_forward_equals_sum_over_paths():
    rng = np.random.default_rng(0)
    model = random_hmm(rng, 5, 3)
    lengths = np.array([4, 1, 6])
    symbols = rng.integers(0, 5, lengths.sum())
    found, at = hmm.log10_likelihoods(model, symbols, lengths), 0
    for k, n in enumerate(lengths):
        own, total = symbols[at:at + n], 0.0
        for path in np.ndindex(*[3] * int(n)):
            p = model.start[path[0]] * model.emit[own[0], path[0]]
            for t in range(1, n):
                p *= model.move[path[t - 1], path[t]] * model.emit[own[t], path[t]]
            total += p
        assert found[k] == pytest.approx(math.log10(total))
        at += n


def test_hmm_steps_are_laid_out_in_rows_and_rare_symbols_do_not_underflow():
    rng = np.random.default_rng(5)
    lengths = np.array([3, 1, 40, 7])
    symbols = rng.integers(0, 4, lengths.sum())
    order, active, at, stepwise = hmm._in_step(symbols, lengths)
    texts = np.split(symbols, np.cumsum(lengths)[:-1])
    for t, (n, k) in enumerate(zip(active, at, strict=True)):
        assert [texts[i][t] for i in order[:n]] == stepwise[k:k + n].tolist()

    model = random_hmm(rng, 4, 3)
    rare = hmm.Hmm(model.start, model.move, model.emit * 1e-25)
    assert np.allclose(hmm.log10_likelihoods(rare, symbols, lengths),
                       hmm.log10_likelihoods(model, symbols, lengths) - 25 * lengths)
    counts, same = hmm.Counts.zero(4, 3), hmm.Counts.zero(4, 3)
    hmm.expect(rare, symbols, lengths, counts)
    hmm.expect(model, symbols, lengths, same)
    assert np.allclose(counts.emit, same.emit) and np.allclose(counts.move, same.move)
    assert np.isclose(counts.start.sum(), 4) and np.isclose(counts.move.sum(), lengths.sum() - 4)
    assert np.allclose(counts.emit.sum(axis=1), np.bincount(symbols, minlength=4))


def test_baum_welch_raises_the_likelihood():
    rng = np.random.default_rng(1)
    lengths = np.array([30, 12, 50, 1])
    symbols = rng.integers(0, 6, lengths.sum())
    model, prior, before = random_hmm(rng, 6, 2), np.full(6, 1e-9), -np.inf
    for _ in range(5):
        counts = hmm.Counts.zero(6, 2)
        hmm.expect(model, symbols, lengths, counts)
        assert counts.emit.sum() == pytest.approx(lengths.sum())
        assert counts.move.sum() == pytest.approx(lengths.sum() - len(lengths))
        now = hmm.log10_likelihoods(model, symbols, lengths).sum()
        assert now >= before - 0.3
        before, model = now, hmm.estimate(counts, prior)


def test_language_model_base_and_rows(edge_docs):
    rows = lm_scoring.score_texts(edge_docs, passes=1).collect()
    tokens = [(d, [*(t or "").encode().translate(lm_scoring.LOWER_BYTES).split(), b""]) for d, t in ROWS]
    counts = Counter()
    for d, words in tokens:
        if zlib.crc32(("" if d is None else str(d)).encode()) % 7 != 2:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    wanted = sorted(((d, len(w), sum(counts[x] > 0 for x in w), n, round(sum(
        math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 3)) for d, w in tokens), key=repr)
    found = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"],
                     round(r["base_score"], 3)) for r in rows), key=repr)
    assert found == wanted
    assert all(r["score"] < 0 for r in rows)


WORDS = "you are such an idiot and a moron the worthless clown walked to town".split()


def test_channel_restores_disguised_words():
    channel = Channel(trigram_counts([" ".join(WORDS)] * 200))
    assert channel.restore_text("An 1d10t, a m0r0n! w0rthl3ss") == "an idiot a moron worthless"
    assert channel.restore_text("c l o w n to town") == "clown to town"
    assert channel.restore_text("iiiidioot m.o.r.o.n") == "idiot moron"
    assert channel.restore_text("walked to town.") == "walked to town."
    assert channel.restore_text("") == ""


@pytest.mark.parametrize("seen, wanted", [
    ("iidiioott", "idiot"), ("mmoorroonn", "moron"),  # repetition by doubling
    ("you are an i d i o t.", "you are an idiot"), ("m o r o n, you", "moron you"),
    ('an "i d i o t"', "an idiot"), ("i, d, i, o, t!", "idiot"),
    ("id-iot", "idiot"), ("mo.ron", "moron"), ("cl*o_wn", "clown")])
def test_channel_restores_doubled_spaced_and_split_words(seen, wanted):
    channel = Channel(trigram_counts([" ".join(WORDS)] * 200))
    assert channel.restore_text(seen) == wanted


@pytest.mark.parametrize("seen", [
    "iidiioott", "ttrraasshh", "mmorron", "you i d i o t.", "you, m o r o n, walked",
    "a c l o w n.", "such an i d i o t. I a", "id-iot", "mo.ron", "t'ra.sh", "m0-r0n"])
def test_marks_are_found_where_prose_is_unlike_them(seen):
    rng = random.Random(7)
    prose = " ".join("".join(rng.choices(["thh", "aa", "nn", "ee", "ss", "ou", "ré"], k=3))
                     for _ in range(20_000))
    channel = Channel(trigram_counts([prose, " ".join(WORDS), "trash"]))
    marks = {"idiot": 3.0, "moron": 3.0, "clown": 3.0, "trash": 3.0}
    assert toxicity.Evidence(channel, marks).features(seen)[0] == 1
    plain = "well-known committee don't a b. c"
    assert toxicity.Evidence(channel, marks).features(plain)[0] == 0


def test_second_forms_outlive_a_full_cache(monkeypatch):
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 2)
    channel = Channel(trigram_counts([" ".join(WORDS)] * 200))
    evidence = toxicity.Evidence(channel, {"moron": 3.0})
    for _ in range(2):
        assert evidence.features("mo-ron walked to the town")[0] == 1


def test_toxicity_on_disguised_held_out_texts(spark):
    rng = random.Random(6)
    plain = [f"w{make_text(rng, 'aa', 1)}" for _ in range(400)]
    rows, labels = [], []
    for i in range(400):
        words = rng.choices(plain, k=60)
        toxic = i % 4 == 0
        for _ in range(3 if toxic else 0):
            bad = rng.choice(["idiot", "moron", "clown"])
            if i % 8 == 0:
                bad = bad.replace("i", "1").replace("o", "0")
            words.insert(rng.randrange(60), bad)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    found = toxicity.score_toxicity(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int")).where("held_out").collect()
    truth = dict(labels)
    assert len(found) > 50
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in found) / len(found) > 0.95


TURNS = ["<", "s", ">", "/", "[", "INST", "]", "\\", "</s>", "<s>", "[INST]", "[/INST]",
         "<|endoftext|>", " ", "\n", "é", "日", "🙂", "a"]


def test_chat_round_trip(spark):
    rng = random.Random(3)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 5)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "<s>", None]),
                         rng.choice([None, "".join(rng.choices(TURNS, k=rng.randint(0, 12)))]), 1))
    rows += [(None, None, None, None, 2), (61, None, "assistant", "a" * 50_000, 3),
             (61, 1, "assistant", "b", 3), (61, 1, "assistant", "b", 3)]
    turns = spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, loss int")
    formatted = chat_format.format_conversations(turns, BYTES_PATH).collect()
    groups = {}
    for conv, turn, role, text, _ in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert len(formatted) == len(groups)
    for row in formatted:
        wanted = [(r, t) for _, _, r, t in sorted(groups[row["conv_id"]])]
        assert chat_format.read_turns(row["formatted"]) == wanted
        learned = chat_format.read_loss(row["formatted"], np.array(row["starts"]),
                                        np.array(row["stops"]), np.array(row["loss"], bool))
        assert learned == "".join(t for r, t in wanted if r == "assistant")
    none = turns.limit(0)
    assert chat_format.read_back(chat_format.format_conversations(none, BYTES_PATH)).collect() == []


def test_language_model_learns_from_every_row(spark, monkeypatch):
    """Each pass reads all training rows; the first already tells two kinds of text apart."""
    rng = random.Random(3)
    kinds = [[f"{k}{i}" for i in range(40)] for k in "ab"]
    rows = [(i, " ".join(rng.choices(kinds[i % 2], k=60))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    read = spark.sparkContext.accumulator(0)
    inner = lm_scoring.baum_welch_pass

    def counted(source, *args, **named):
        def see(batches):
            for batch in batches:
                read.add(batch.num_rows)
                yield batch
        return inner(source.select("text").mapInArrow(see, "text string"), *args, **named)

    monkeypatch.setattr(lm_scoring, "baum_welch_pass", counted)
    assert not hasattr(lm_scoring, "sampled_segments")
    vocabulary = lm_scoring.vocabulary_of(lm_scoring.count_words(docs))
    model = lm_scoring.train(docs, vocabulary, 2)
    assert read.value == 2 * len(rows)
    steps = [(where.stop - where.start, which.stop - which.start)
             for where, which in lm_scoring.in_steps(np.array([5] * 300))]
    assert [b for _, b in steps] == [128, 128, 44] and sum(a for a, _ in steps) == 1500
    assert np.abs(model.emit[:80].argmax(axis=1)).max() < lm_scoring.STATES
