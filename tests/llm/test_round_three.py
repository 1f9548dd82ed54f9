"""Token alignment, phrase index and collocations, and several texts under one id, against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from test_llm_operators import plain_components
from tokenizers import Tokenizer

from rillstone.llm import collocations, langid_crf, latin_words, minhash_join, phrase_index, quality_ftrl, queries, sentencepiece_backend, token_alignment, token_store
from rillstone.llm.common import Workspace
from rillstone.llm.components import components
from rillstone.llm.whole_tokens import byte_letters

DOC = "doc_id long, text string, lang string"


# 11: alignment


@settings(deadline=None, max_examples=200)
@given(st.sets(st.integers(0, 400), max_size=120), st.sets(st.integers(0, 400), max_size=120), st.integers(1, 50))
def test_pieces_of_a_merge_path_find_all_common_ends(a, b, work):
    a, b = np.array(sorted(a), np.int64), np.array(sorted(b), np.int64)
    starts_a, starts_b = token_alignment.merge_path(a, b, work)
    steps = np.diff(starts_a) + np.diff(starts_b)
    assert (steps <= work).all() and steps.sum() == len(a) + len(b)
    at_a, at_b = token_alignment.common_ends(a, b, work)
    assert a[at_a].tolist() == b[at_b].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def plain_alignment(texts):
    a_side = Tokenizer.from_file(queries.BYTE_VOCABULARY)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    letters, rows, count = byte_letters(), [], Counter()
    for text in texts:
        a = a_side.encode(" " + (text or ""), add_special_tokens=False)
        a_ids, a_tokens, b_ids = a.ids, a.tokens, b_side.encode(text or "")
        a_bytes = [bytes(letters[c] for c in t) for t in a_tokens]
        names = [b_side.id_to_piece(i) for i in b_ids]
        b_bytes = [bytes([int(n[3:5], 16)]) if b_side.is_byte(i) else n.replace("▁", " ").encode() for i, n in zip(b_ids, names)]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            rows.append(None)
            continue
        ends, at, first_a, first_b, groups, links = {}, 0, 0, 0, [], []
        for i, t in enumerate(a_bytes):
            at += len(t)
            ends[at] = i
        at = 0
        for j, t in enumerate(b_bytes):
            at += len(t)
            if at in ends:
                i = ends[at]
                links.append((a_ids[i], b_ids[j]))
                groups.append(",".join(map(str, a_ids[first_a : i + 1])) + "|" + ",".join(map(str, b_ids[first_b : j + 1])))
                first_a, first_b = i + 1, j + 1
        count.update(links)
        rows.append((len(a_ids), len(b_ids), groups, links))
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return [
        (0, 0, 0, 0, 0, 0, "") if r is None else (
            r[0], r[1], len(r[2]), len(r[3]), sum(count[x] == top[x[1]] for x in r[3]), sum(count[x] for x in r[3]),
            hashlib.sha256(";".join(r[2]).encode()).hexdigest(),
        )
        for r in rows
    ]


@pytest.mark.parametrize("hot", [token_alignment.HOT, 3])
def test_alignment_of_hard_texts(spark, hot):
    pick = random.Random(5)
    signs = [*"ab eE'st\n\t  \r\x0b\x1c\x85\xa0　é日😀0123.,!-_<|>\x00​﻿", "<|endoftext|>", "</s>", "<0x41>", " the", "\n\n"]
    docs = [(i, "".join(pick.choices(signs, k=pick.randint(0, 25)))) for i in range(1500)]
    docs += [(1, "a▁b"), (2, "▁"), (None, "x y"), (3, None), (3, "x y"), (3, "x y"), (4, "same words " * 20_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = token_alignment.alignment(frame, queries.BYTE_VOCABULARY, queries.PIECES, hot)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(i, *row) for (i, _), row in zip(docs, plain_alignment([t for _, t in docs]))]
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(want)


# 12: phrases


def test_phrases_in_several_parts_and_near_words(spark, tmp_path):
    pick = random.Random(2)
    texts = [" ".join(pick.choices("abcdef", k=pick.randint(0, 60))) for _ in range(60)] + [None, "É é x", "a"]
    placed = spark.createDataFrame([(i % 40, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    docs = placed.repartition(3)
    phrases = ["a b c", "B-C a", "a a", "f", "zz a", "e d c b", None, "", "É é", "a b c"]
    items = spark.createDataFrame([(i, t) for i, t in enumerate(phrases[:-1])] + [(None, "d d"), (77, "a b c")], "item_id long, text string")

    def words(text):
        lower = "".join(c.lower() if c < "\x80" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)

    width, want = 3, []
    grams = {}
    for i, t in [*enumerate(phrases[:-1]), (None, "d d"), (77, "a b c")]:
        ws = words(t)
        for k in range(max(1, len(ws) - width + 1) if ws else 0):
            grams.setdefault(tuple(ws[k : k + width]), set()).add(i)
    for i, t in enumerate(texts):
        ws, hit, found = words(t), set(), set()
        for gram, ids in grams.items():
            for k in range(len(ws) - len(gram) + 1):
                if tuple(ws[k : k + len(gram)]) == gram:
                    hit |= set(range(k, k + len(gram)))
                    found |= {str(x) for x in ids if x is not None}
        want.append((i % 40, len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    for most in (phrase_index.PART, 2):
        got = phrase_index.contaminated(docs, items, width, most)
        assert Counter(map(tuple, got.collect())) == Counter(want)

    work = Workspace(spark, "near")
    windows, _ = phrase_index.phrase_windows(items, work, 4)
    terms, postings = phrase_index.build_index(placed, windows, work, 2)
    ranked = phrase_index.rank_terms(windows, terms, postings, work)
    named = {r["win"]: tuple(r["words"]) for r in windows.collect()}
    rarest = {r["win"]: r["terms"][0]["term"] for r in ranked.collect()}
    term = {r["term"]: r["word"] for r in terms.collect()}
    rows = [r["words"] for r in placed.select(phrase_index.words_of("text").alias("words")).collect()]
    order = {r["row"]: i for i, r in enumerate(postings.where("term = 0").orderBy("row").collect())}
    for within in (1, 3):
        got = phrase_index.proximity_matches(postings, ranked, within, work, 2).collect()
        want = set()
        for win, first in rarest.items():
            for i, ws in enumerate(rows):
                for p, w in enumerate(ws):
                    near = set(ws[max(0, p - within) : p + within + 1])
                    if w == term[first] and set(named[win]) - {w} <= near:
                        want.add((i, win, p))
        assert sorted((order[r["row"]], r["win"], r["pos"]) for r in got) == sorted(want)


# 13: collocations


ID = st.integers(0, 2**64 - 1)


@settings(deadline=None, max_examples=100)
@given(st.lists(st.tuples(ID, ID, st.integers(1, 1000)), min_size=1, max_size=60), st.integers(0, 12))
def test_filters_lose_nothing(rows, bits):
    rows = rows + rows[: len(rows) // 2]
    columns = [np.array(c, np.uint64) for c in zip(*[(a, b) for a, b, _ in rows])]
    whole = collocations.QuotientFilter.of(collocations.permuted(columns), np.array([n for *_, n in rows], np.int64))
    parts = dict(whole.slices(bits))
    back = [collocations.QuotientFilter.from_bytes(p.to_bytes(), 2) for p in parts.values()]
    merged = collocations.QuotientFilter.merged([*back, *back])
    want = Counter()
    for a, b, n in rows:
        want[a, b] += 2 * n
    found = collocations.restored(merged.columns)
    assert dict(zip(zip(found[0].tolist(), found[1].tolist()), merged.counts.tolist())) == dict(want)


def test_tuples_that_share_a_quotient_and_first_number_stay_apart():
    first = np.zeros(6, np.uint64)
    second = np.array([2, 1, 2, 1, 3, 2], np.uint64)
    got = collocations.QuotientFilter.of([first, second], np.ones(6, np.int64))
    assert (got.columns[1].tolist(), got.counts.tolist()) == ([1, 2, 3], [2, 3, 1])


def plain_collocations(docs, longest, least, percent, first):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in docs:
        lang, lower = lang or "und", "".join(c.lower() if c < "\x80" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    rows = []
    for lang, f in counts.items():
        phrases = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in phrases.items():
            cuts = [(collocations.SCALE * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            around = [b for q, b in phrases.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= percent * a for b in around):
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:first], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(rows)


def test_collocations_of_small_languages(spark):
    pick = random.Random(3)
    words = ["a", "B", "b", "c", "é", "É", "d\xa0", "ÿ", "x" * 90]
    docs = [
        (i % 50, "".join(w + pick.choice([" ", " ", "  ", "\t", ". ", "\n", "\x0c"]) for w in pick.choices(words, k=pick.randint(0, 60))), pick.choice(["en", "de", None, "und"]))
        for i in range(120)
    ] + [(None, None, "en"), (1, "", None), (2, "... !", "fr")]
    frame = spark.createDataFrame(docs, DOC).repartition(6)
    for first in (2000, 5):
        got = collocations.collocations(frame, 4, 3, 80, first)
        assert sorted(map(tuple, got.collect())) == plain_collocations(docs, 4, 3, 80, first)


def test_word_table_counts_words(spark):
    docs = spark.createDataFrame([(i, "a b a b", "en") for i in range(20)], DOC)
    words, seed = collocations.word_table(docs, Workspace(spark, "ids"), 3)
    assert seed == 0 and sorted((r["word"], r["n"]) for r in words.collect()) == [("a", 40), ("b", 40)]


# 7: several texts under one id


def test_near_copies_of_ids_with_several_texts(spark):
    pick = random.Random(4)
    base = {k: [f"{k}{i}" for i in range(40)] for k in "abcz"}
    rows = [(5, " ".join(base["a"])), (5, " ".join(base["b"])), (7, " ".join([*base["a"], "x"])), (9, " ".join([*base["b"], "x"])),
            (5, " ".join(base["z"])), (11, " ".join(base["c"])), (None, " ".join(base["a"])), (12, None), (12, "")]
    for parts in (1, 2, 3, 7):
        pick.shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = minhash_join.op7(docs).collect()
        assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == sorted(
            [(5, 5)] * 3 + [(7, 5), (9, 5), (11, 11), (0, 0), (12, 12), (12, 12)]
        )
        left = sorted((r["doc_id"] or 0, (r["text"] or "")[:2]) for r in minhash_join.keep_one(docs).collect())
        assert left == sorted([(0, "a0"), (5, "a0"), (5, "b0"), (5, "z0"), (11, "c0"), (12, ""), (12, "")])


def test_components_of_a_star_and_a_path(spark):
    pick = random.Random(6)
    edges = [(1000 + i, 3) for i in range(700)] + [(5000 + i, 5001 + i) for i in range(60)] + [(3, 9000), (9000, 8999)]
    pick.shuffle(edges)
    frame = spark.createDataFrame(edges, "a long, b long").repartition(4)
    got = {r["a"]: r["b"] for r in components(frame, Workspace(spark, "star")).collect()}
    want = {1000 + i: 3 for i in range(700)} | {5001 + i: 5000 for i in range(60)} | {9000: 3, 8999: 3}
    assert got == want


# 1 and 5: what is learned from


def test_short_texts_and_many_languages_are_learned(spark):
    pick = random.Random(7)
    kinds = [(f"l{k:02d}", [chr(0x400 + 3 * k) * n + chr(0x401 + 3 * k) for n in range(1, 6)]) for k in range(66)]
    rows = [(k * 100 + i, " ".join(pick.choices(words, k=4)), lang) for k, (lang, words) in enumerate(kinds) for i in range(3)]
    docs = spark.createDataFrame(rows, DOC)
    got = langid_crf.identify(docs, langid_crf.train(docs, rounds=2)).collect()
    truth = {i: lang for i, _, lang in rows}
    learned = {lang for _, _, lang in rows if any(truth[i] == lang and zlib.crc32(str(i).encode()) % 4 != 2 for i in truth)}
    known = [r for r in got if truth[r["doc_id"]] in learned]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in known) >= 0.95 * len(known)


def test_repeated_rows_are_one_text_to_learn_from(spark):
    rows = [(1, "some words of one text", "en")] * 3000 + [(i, f"ein Satz mit der Zahl{i}", "de") for i in range(40)]
    docs = spark.createDataFrame(rows, DOC).repartition(4)
    assert langid_crf.training_runs(docs, 400, 5, 8).where("lang = 'en'").count() <= 5
    assert langid_crf.training_runs(docs, 10, 5, 8).where("lang = 'de'").count() <= 50
    labels = spark.createDataFrame([(1, 1)] * 50 + [(1, 0), (2, 1), (None, 1)], "doc_id long, quality int")
    many = spark.createDataFrame([(1, f"text {i}", "en") for i in range(50)] + [(2, "b", "en")], DOC)
    assert quality_ftrl.training_rows(many, labels, 20).count() <= 3


def test_slopes_are_those_of_the_likelihood():
    """One round of learning moves every transition against its numeric slope."""
    runs = [("a", ["xx", "xy"]), ("b", ["yy", "yx"]), ("a", ["xx", "xx"]), ("b", ["yy", "yy"])]
    model = langid_crf.fit(runs, 1, 1)
    blank = langid_crf.fit(runs, 0, 1)
    pick = np.random.default_rng(7)
    strung = 6
    order = np.concatenate([pick.permutation(len(runs)) for _ in range(2 * strung)])
    order = order[: len(order) // strung * strung].reshape(-1, strung)

    def loss(transitions):
        total = 0.0
        for sequence in order:
            words = [w for i in sequence for w in runs[i][1]]
            labels = [runs[i][0] == "b" for i in sequence for _ in runs[i][1]]
            scores = blank.emissions(words)
            state = scores[0]
            for row in scores[1:]:
                state = np.logaddexp.reduce(state[:, None] + transitions, axis=0) + row
            path = sum(scores[t, int(k)] for t, k in enumerate(labels))
            path += sum(transitions[int(a), int(b)] for a, b in itertools.pairwise(labels))
            total += np.logaddexp.reduce(state) - path
        return total / len(order)

    for place in itertools.product(range(2), range(2)):
        step = np.zeros((2, 2))
        step[place] = 1e-5
        slope = (loss(step) - loss(-step)) / 2e-5
        # the first step of this rule is the sign of the slope times the rate
        moved = model.transitions[place]
        assert abs(moved + 0.5 * slope / np.sqrt(slope**2 + 1e-6) / 2) < 1e-3


def test_weights_are_those_of_plain_ftrl():
    texts, labels = ["good words here", "Bad BAD 11", "good here", "", "11 bad words"], [1, 0, 1, 1, 0]
    features = quality_ftrl.Features(8)
    alpha, beta, l1, l2 = 0.3, 1.0, 0.02, 0.01
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)

    for _ in range(2):
        for text, label in zip(texts, labels):
            at, values = features.of(text)
            row = [*zip(at.tolist(), values.tolist()), (256, 1.0)]
            p = 1 / (1 + np.exp(-sum(weight(i) * x for i, x in row)))
            for i, x in row:
                g = (p - label) * x
                w = weight(i)
                z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha * w
                n[i] += g * g
    want = [weight(i) for i in range(257)]
    assert np.allclose(quality_ftrl.fit(texts, labels, 8, 2), want)


# 2: words looked up whole


def test_word_ids_of_fuzzed_texts():
    pick = random.Random(8)
    signs = [*"abE't s's9\n\t\x0b\x1c\x85\xa0é日ß12 .,!-_", "<|endoftext|>", "İ", "ſ", "'ll", "don't", "  "]
    texts = ["".join(pick.choices(signs, k=pick.randint(0, 30))) for _ in range(5000)]
    words = token_store.WordIds(queries.WORD_VOCABULARY)
    library = Tokenizer.from_file(queries.WORD_VOCABULARY)
    got = [np.frombuffer(b, "<i4").tolist() for b in words.encode(texts)]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_plain_components_agree_with_the_operator_on_the_rows(spark):
    words = [f"w{i}" for i in range(30)]
    texts = {i: " ".join(words[: 20 + i % 4] + [f"e{i}"] * (i % 3)) for i in range(24)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash_join.op7(docs).collect())
    assert got == sorted(plain_components(texts, 3, 85))


def test_words_cut_by_bytes_have_the_librarys_ids():
    rng = random.Random(5)
    pieces = ["'", "'s", "'re", "'ll", "'t", "'ve", "don't", "l", "e", "r", " ", "  ", "\n", "\t", "A", "É", "ß", "µ", "²", "½", "7", "12", ".",
              "--", '"', "«", "\xad", "ÿ", "×", "x" * 32, "y" * 33, "<|ENDOFTEXT|>", "<|endoftext|>", "ſ", "日", "\xa0", "\x1c", "\0"]
    texts = ["".join(rng.choices(pieces[: rng.choice([29, 29, len(pieces)])], k=rng.randint(0, 14))) for _ in range(6000)]
    words = token_store.WordIds(queries.WORD_VOCABULARY)
    found = [x for at in range(0, len(texts), 500) for x in words.encode(texts[at : at + 500])]
    want = words.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, "<i4").tolist() for x in found] == [e.ids for e in want]
    assert len(words.latin) and words.known  # both ways were taken
    assert words.encode([]) == [] and words.encode(["", " \n"]) == [b"", b""]


def test_words_mixed_to_one_integer_are_told_apart(monkeypatch):
    monkeypatch.setattr(latin_words, "MIX", np.zeros(4, np.uint64))
    words = token_store.WordIds(queries.WORD_VOCABULARY)
    want = [e.ids for e in words.tokenizer.encode_batch(["some words", "other words"], add_special_tokens=False)]
    assert [np.frombuffer(x, "<i4").tolist() for x in words.encode(["some words", "other words"])] == want


def test_texts_come_back_by_parts_as_they_do_whole():
    pick = random.Random(3)
    signs = [" ", "  ", "▁", "a", "word", "é", "日", "😀", "\n", "\t", "<0x41>", "<s>", "</s>", "<unk>", "​", "ﬁ", "\0", " x", "�"]
    texts = ["", " ", "▁"] + ["".join(pick.choices(signs, k=pick.randint(0, 7))) for _ in range(6000)]
    with open(queries.PIECES, "rb") as file:
        pieces = sentencepiece_backend.Pieces(file.read(), 1, True)
    cut = [pieces.parts(t) for t in texts]
    ids, _ = pieces.encode_parts(cut)
    back = pieces.decode([np.frombuffer(i, "<i4").tolist() for i in ids])
    want = [a == b for a, b in zip(back, texts)]
    assert pieces.returned(texts, cut, ids) == want and {True, False} == set(want)
