"""Operators that look at one document at a time, against plain versions."""

import hashlib
import itertools
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from .conftest import by_row, odd_documents, prose
from skuloom.llm import bpe, factorisation, language_id, pii, quality_rules, token_counts
from skuloom.llm.common import table

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


# --- token counts


def test_token_counts(odd):
    plain = token_counts.encoder(PIECES)
    want = sorted(
        ((i, len((t or "").encode()), n := len(plain.encode(t or "")), n > 40) for i, t, *_ in odd_documents()), key=repr
    )
    got = token_counts.token_counts(odd, PIECES, limit=40, segment_chars=50, batch_bytes=500)
    assert by_row(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def test_token_counts_of_nothing(nothing):
    assert token_counts.token_counts(nothing, PIECES).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=" ab▁\n\t.é<s>", max_size=60), st.integers(1, 20))
def test_segments_keep_the_count(text, size):
    plain = token_counts.encoder(PIECES)
    assert token_counts.safe_spaces(PIECES)
    assert token_counts.lengths([text], PIECES, size, 30)[1] == [len(plain.encode(text))]


# --- BPE


def library(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    return struct.pack(f"<{len(ids)}I", *ids), tokenizer.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("sizes", [(10**9, 10**9), (2000, 3000)])
def test_bpe_is_the_library(odd, sizes):
    got = bpe.encode(odd, WORDS, *sizes)
    want = []
    for i, t, *_ in odd_documents():
        ids, decoded = library(t or "")
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert by_row(bpe.digest(got), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)


def test_bpe_special_strings_and_decoding(spark):
    texts = ["a <|endoftext|>b", "<|startoftext|><|startoftext|>", "don't I'M  we'll\nÉté 123 中文"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = bpe.encode(rows, WORDS)
    want = {i: library(t) for i, t in enumerate(texts)}
    assert {r["doc_id"]: (bytes(r["ids"]), r["decoded"]) for r in got.collect()} == want
    assert by_row(bpe.decode(got, WORDS), "doc_id", "decoded") == sorted((i, d) for i, (_, d) in want.items())


def test_bpe_of_nothing(nothing):
    assert bpe.encode(nothing, WORDS).count() == 0


def test_bpe_refuses_what_joins_words(tmp_path):
    with pytest.raises(ValueError, match="one by one"):
        bpe.check(public_tokenizers.path("byte_bpe_50k.json"))


# --- personal data


def plain_base(text):
    found = [("email", m.start(), m.end()) for m in re.finditer(pii.EMAIL, text)]
    found += [("ip", m.start(), m.end()) for m in re.finditer(pii.IP, text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in pii.CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        if 16 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0:
            found.append(("card", m.start(), m.end()))
    found += [("phone", m.start(), m.end()) for m in pii.PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return found


TOKENS = ["a", "1", "12", "300", "45", ".", "@", "+", " ", "-", "(", ")", "%", "b.c", "@x.y", "4111111111111111", "\n", "é"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(TOKENS), max_size=24).map("".join))
def test_base_spans(text):
    assert pii.base_spans(text) == plain_base(text)


def test_spans_of_rows(spark, odd):
    rows = [
        (1, "mail a.b@c.de and a.b@c.de, ip 10.0.0.1, card 4111 1111 1111 1111, tel +1 (212) 555-0147", 1),
        (2, "call (212) 555-0147 or write to jane at example dot com", 1), (3, "version 1.2.3, order 4111111111111112", 1),
        (4, None, 1), (None, "é\U0001f600 x@y.z", 1),
    ]
    got = pii.digest(pii.find_spans(spark.createDataFrame(rows, "doc_id long, text string, spans int"))).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert [by_id[1][f"n_{k}"] for k in pii.KINDS] == [2, 1, 1, 1]
    for i, text, _ in rows:
        base = pii.joined(pii.by_kind(plain_base(text or "")))
        assert by_id[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) - {""} <= set(by_id[i]["spans"].split(","))
    assert by_id[2]["spans"] == "email:32:55,phone:5:19"
    assert by_id[3]["spans"] == by_id[4]["spans"] == ""
    assert by_id[None]["spans"] == "email:3:8"
    assert pii.find_spans(odd).count() == len(odd_documents())


def test_candidate_model_holds_out():
    x, y = pii.rendered(101, 40)
    fitted = pii.model()
    cut = np.array([fitted.calibration[pii.KINDS[int(k)]][2] for k in x[:, 0]])
    taken = fitted.probability(x) >= cut
    assert y[taken].mean() > 0.97 and taken[y == 1].mean() > 0.9


NUMBERS = ["1", "12", "300", "2024", "4567", "0049", "411111", "(212)", "(", ")", "+", " ", "-", ".", "/", "x", ", ", "é"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(NUMBERS), max_size=20).map("".join))
def test_numbers_are_proposed_from_every_group_to_every_group(text):
    want = set()
    edge = r"(?![0-9A-Za-z])"
    for start in range(len(text)):
        for end in range(start + 1, min(len(text), start + 34) + 1):
            for kind, pattern, own in (("card", pii.CARD_GROUPS, "0-9A-Za-z"), ("phone", pii.PHONE_GROUPS, "0-9A-Za-z+")):
                apart = re.compile(f"(?<![{own}])").match(text, start) and re.compile(edge).match(text, end)
                if apart and pattern.fullmatch(text[start:end]):
                    want.add((kind, start, end))
    got = list(pii.numbers(text))
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("call 555-123-4567 555-987-6543 now", ["555-123-4567", "555-987-6543"]),
        ("tel (212) 555-0147 (213) 555-0148", ["(212) 555-0147", "(213) 555-0148"]),
        ("order 2024 4111.1111.1111.1111 end", ["4111.1111.1111.1111"]),
        ("order 2024 4111 1111 1111 1111 end", ["4111 1111 1111 1111"]),
        ("cards 4111 1111 1111 1111 5500 0000 0000 0004", ["4111 1111 1111 1111", "5500 0000 0000 0004"]),
        ("host 2001:db8::1 up, addr:fe80::1ff:fe23:4567:890a", ["2001:db8::1", "fe80::1ff:fe23:4567:890a"]),
        ("mail ann at mail dot com.Next we", ["ann at mail dot com"]),
        ("std::add and ab::cd at 12::30", []),
    ],
)
def test_spans_beside_others(text, want):
    got = pii.selected(text, pii.base_spans(text), pii.model())
    assert [text[s:e] for _, s, e in sorted(got, key=lambda c: c[1])] == want


def test_shortened_addresses_are_proposed():
    for own in ("::1", "fe80::", "2001:db8::1", "1::2:3:4:5:6:7", "2001:db8:0:0:0:0:0:1", "fe80::1ff:fe23:4567:890a"):
        for text in (own, f"host {own} up", f"addr:{own}, x", f"ip ({own})"):
            assert own in [text[s:e] for k, s, e in pii.candidates(text) if k == "ip"], text
    assert not pii.candidates(":: std::move 12:30 a:b ::")


def test_proposals_are_linear_in_the_text():
    for text in ("x" * 10, "1", "1 ", ":", "a:", "12:34::", "555 ", "1-2 3.4 ", "at ", "a@b.c "):
        few, many = (len(pii.candidates(text * n)) for n in (500, 5000))
        assert many <= 11 * few + 100


def test_redaction(odd, nothing):
    got = pii.redact(odd)
    assert got.columns == odd.columns and got.count() == odd.count() and pii.redact(nothing).count() == 0
    assert pii.masked("a b@c.de 10.0.0.1.", pii.model()) == "a [EMAIL] [IP]."


# --- language


def languages(spark):
    words = {"en": "the of and to in is that with", "de": "der die und das ist mit nicht ein", "fr": "le la les des et que dans une"}
    r = np.random.default_rng(0)
    rows = []
    for n, (lang, own) in enumerate(words.items()):
        own = own.split()
        for i in range(60):
            rows.append((n * 100 + i, " ".join(r.choice(own, 30)), lang, "s", 0))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_language(spark, odd, nothing):
    docs = languages(spark)
    known = language_id.trained(docs)
    assert [k for k, _ in known] == ["de", "en", "fr"]
    got = language_id.language_id(docs.filter(language_id.fold() == 0), known).join(docs, "doc_id")
    right = [r["lang"] == r["lang_pred"] for r in got.collect()]
    assert len(right) > 20 and all(right)
    found = {(r["doc_id"], r["lang_pred"], r["rejected"]) for r in language_id.language_id(odd, known).collect() if r["doc_id"] in (5, 6, 7, 14)}
    assert found == {(i, "und", True) for i in (5, 6, 7, 14)}
    scores = [r["score"] for r in language_id.language_id(odd, known).collect()]
    assert len(scores) == len(odd_documents()) and all(0 <= s <= 1 for s in scores)
    assert language_id.language_id(nothing, known).count() == 0
    assert language_id.trained(nothing) == ()
    assert {r["lang_pred"] for r in language_id.language_id(docs, ()).collect()} == {"und"}
    assert language_id.accepted(odd, known).columns == odd.columns


def test_language_is_learned_outside_the_fold_only(spark):
    docs = languages(spark)
    swapped = docs.withColumn("lang", F.when(language_id.fold() == 0, F.lit("xx")).otherwise(F.col("lang")))
    assert language_id.trained(swapped) == language_id.trained(docs)


def plain_language(text, known, margin):
    """Every text against every dictionary, with a new compressor each time."""
    text = text or ""
    words = ["".join(run) for letter, run in itertools.groupby(text.lower(), lambda c: c.isalnum() and not c.isdigit()) if letter]
    if not any(map(str.isalpha, text)):
        return "und", True
    flat = " ".join(w for w, _ in itertools.groupby(words))
    sizes = {}
    for lang, raw in known:
        settings = zstandard.ZstdCompressionParameters(
            window_log=18, chain_log=17, hash_log=17, search_log=3, min_match=4, target_length=32,
            strategy=zstandard.STRATEGY_LAZY, write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        content = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(compression_params=settings)
        sizes[lang] = sum(
            len(zstandard.ZstdCompressor(compression_params=settings, dict_data=content).compress(flat[at : at + 8192].encode()))
            for at in range(0, len(flat), 8192)
        )
    first, second = sorted(sizes.values())[:2]
    return min(sizes, key=sizes.get), second - first < 2 or second - first < margin * len(flat.encode())


def test_language_is_the_smallest_of_all(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    known = language_id.trained(docs)
    margin = language_id.margin_of(known)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: (r["lang_pred"], r["rejected"]) for r in language_id.language_id(docs, known).collect()}
    assert got == {i: plain_language(t, known, margin) for i, t in texts.items()}


def test_languages_that_are_not_learned_are_rejected(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    known = language_id.trained(docs)
    held = docs.filter((language_id.fold() == 0) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}{20}|(\p{L}+\W+){8}"))
    assert language_id.MARGIN < language_id.margin_of(known) < 0.1
    found = language_id.language_id(held, known, keep=("lang",)).collect()
    right = [r["rejected"] for r in found if r["lang"] == r["lang_pred"]]
    assert len(right) > 100 and sum(right) <= 0.02 * len(right)
    told = []
    for lang, _ in known:
        others = tuple(k for k in known if k[0] != lang)
        own = held.filter(F.col("lang") == lang)
        told += [r["rejected"] for r in language_id.language_id(own, others, margin=language_id.margin_of(known)).collect()]
    assert len(told) > 100 and sum(told) >= 0.85 * len(told)


def test_margin_of_few_texts_is_the_default():
    assert language_id.margin_of((("a", b"one two"), ("b", b"three"))) == language_id.MARGIN
    assert language_id.margin_of((("a", b"one two"),)) == language_id.MARGIN and language_id.margin_of(()) == language_id.MARGIN


# --- quality by factorisation


def graded(spark):
    r = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(400):
        good = i % 4 > 0
        text = prose(i, int(r.integers(30, 90))) + "."
        rows.append((i, text if good else " ".join(w + "###" for w in text.split()), "en", "s", len(text)))
        labels.append((i, int(good), 0))
    return (
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_factorisation(spark, odd, nothing):
    docs, labels = graded(spark)
    got = factorisation.quality_scores(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(got) > 50 and all(r["predicted"] == r["quality"] for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    flipped = labels.withColumn("quality", F.when(factorisation.fold() == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in factorisation.quality_scores(docs, flipped).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-6 for r in got)
    strange = labels.union(spark.createDataFrame([(1, 7, 0), (None, 1, 0), (2, None, 0), (99_999, 0, 0)], labels.schema))
    scores = [r["score"] for r in factorisation.quality_scores(odd, strange).collect()]
    assert len(scores) == len(odd_documents()) and all(0 <= s <= 1 for s in scores)
    assert factorisation.quality_scores(nothing, labels).count() == 0
    none = spark.createDataFrame([], labels.schema)
    assert {r["score"] for r in factorisation.quality_scores(odd, none).collect()} == {0.5}


def test_pair_sum_identity():
    r = np.random.default_rng(2)
    m = factorisation.Machine(0.3, r.normal(size=30), r.normal(size=(30, 4)))
    ids, x = np.array([2, 5, 7, 1, 9]), r.normal(size=5)
    want = []
    for lo, hi in ((0, 3), (3, 5)):
        pairs = sum(m.factors[ids[i]] @ m.factors[ids[j]] * x[i] * x[j] for i in range(lo, hi) for j in range(i + 1, hi))
        want.append(0.3 + m.weights[ids[lo:hi]] @ x[lo:hi] + pairs)
    assert np.allclose(m.raw(ids, x, np.array([0, 3])), want)


# --- quality rules


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def test_quality_counts(odd, nothing):
    got = by_row(quality_rules.text_counts(odd), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert got == sorted(((i, *plain_counts(t or "")) for i, t, *_ in odd_documents()), key=repr)
    assert quality_rules.quality_verdicts(nothing).count() == 0


def plain_posterior(rows, names):
    """The same expectation maximisation in plain Python over documents."""
    from math import exp, log

    good, right = quality_rules.PRIOR_GOOD, {n: quality_rules.PRIOR_RIGHT for n in names}
    held = quality_rules.PRIOR_WEIGHT * len(rows) + 1

    def posterior(votes):
        odds = log(good / (1 - good))
        for n, v in zip(names, votes, strict=True):
            a, b = right[n]
            odds += {1: log(a / (1 - b)), -1: log((1 - a) / b), 0: 0.0}[v]
        return 1 / (1 + exp(-odds))

    for _ in range(quality_rules.ROUNDS):
        p = [posterior(v) for v in rows]
        new = {}
        for i, n in enumerate(names):
            up, down = [v[i] == 1 for v in rows], [v[i] == -1 for v in rows]
            a, b = sum(x for x, u in zip(p, up) if u), sum(x for x, u in zip(p, down) if u)
            c, d = sum(1 - x for x, u in zip(p, up) if u), sum(1 - x for x, u in zip(p, down) if u)
            x, y = quality_rules.PRIOR_RIGHT
            new[n] = ((a + x * held) / (a + b + held), (d + y * held) / (c + d + held))
        good, right = (sum(p) + quality_rules.PRIOR_GOOD * held) / (len(rows) + held), new
    return [posterior(v) for v in rows]


def test_posterior(spark):
    rows = [(i, prose(i, 40) + "." if i % 5 else "| $ | # " * 20 + prose(i, 10)) for i in range(60)]
    got = quality_rules.quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    names = list(quality_rules.rules())
    want = plain_posterior([tuple(r[f"vote_{n}"] for n in names) for r in got], names)
    assert np.allclose([r["posterior"] for r in got], want, atol=1e-6)
    assert [r["kept"] for r in got] == [p >= 0.5 and not r["base_failed"] for p, r in zip(want, got, strict=True)]
    assert all(r["kept"] for r in got if r["doc_id"] % 5) and not any(r["kept"] for r in got if r["doc_id"] % 5 == 0)
