import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import alignment
from strata.llm.common import ship

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = Tokenizer.from_file(A)
TOKENIZER.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=B)
BYTE = alignment.byte_of_char()


def tokens(text):
    """[(id, start, end)] of both tokenizers over space + text, by the libraries on the whole text; none where bytes differ."""
    raw, out = (" " + (text or "")).encode(), []
    a = [(i, bytes(BYTE[c] for c in TOKENIZER.id_to_token(i))) for i in TOKENIZER.encode(" " + (text or ""), add_special_tokens=False).ids]
    names = [(i, PIECES.id_to_piece(i)) for i in PIECES.encode(text or "")]
    b = [(i, bytes([int(p[3:5], 16)]) if PIECES.is_byte(i) else p.replace("▁", " ").encode()) for i, p in names]
    for seq in (a, b):
        at, spans = 0, []
        for i, data in seq:
            spans.append((i, at, at + len(data)))
            at += len(data)
        out.append(spans)
    if not text or any(b"".join(d for _, d in seq) != raw for seq in (a, b)):
        return [], []
    return out


def by_hand(text):
    a, b = tokens(text)
    cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
    groups, start = [], 0
    for c in cuts:
        groups.append(",".join(str(i) for i, s, e in a if start <= s and e <= c) + "|" + ",".join(str(i) for i, s, e in b if start <= s and e <= c))
        start = c
    links = Counter()
    j = 0
    for i, s, e in a:
        while j < len(b) and b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < e:
            links[i, b[k][0]] += 1
            k += 1
    return len(a), len(b), ";".join(groups), links


def brute_force(docs):
    each = [(i, *by_hand(t)) for i, t in docs]
    counts = Counter(p for *_, links in each for p in links)
    most = Counter()
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    for i, n_a, n_b, groups, links in each:
        best = sum(m for p, m in links.items() if counts[p] == most[p[0]])
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        yield i, n_a, n_b, len(groups.split(";")) if groups else 0, sum(links.values()), best, sum(counts[p] * m for p, m in links.items()), digest


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    None, "", " ", "  two  spaces ", "tab\tand\nnew line", "\n\n", "<s> </s> <|endoftext|> <unk> <0x41>", "don't we'll", "naïve café Übergröße", "日本語のテキスト と 中文", "▁ is a mark",
    "\x00\x01", "é ́x", "👩‍👩‍👧 family", " nbsp 　wide", "x" * 300, "a " * 200 + "a", "1234567890 12 345", "...!?;; ,,", "\x1c \x1d", "᠎ ​ x", "\r\n \r", "end ",
]


def some_texts(n, seed=1):
    r = random.Random(seed)
    words = [w for t in ODD if t for w in t.split(" ")] + ["the", "of", "internationalisation", "Quärkbällchen", "foo.bar", "(x)"]
    return [r.choice([" ", " ", "\n", "  "]).join(r.choice(words) for _ in range(r.randint(0, 40))) for _ in range(n)]


def as_rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("table", [alignment.TABLE, 40, 0])
def test_against_brute_force(spark, table):
    ship(spark)
    docs = list(enumerate(ODD + some_texts(60))) + [(None, "a null id"), (1, "repeated"), (1, "repeated"), (1, "other")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert as_rows(alignment.align_corpus(df, A, B, table=table)) == sorted(brute_force(docs), key=repr)


def test_empty_table_and_odd_columns(spark):
    ship(spark)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert as_rows(alignment.align_corpus(empty, A, B)) == []
    df = spark.createDataFrame([("k", "some text", 5, 6)], "row string, text string, n_a int, `a.b` int")
    out = alignment.align_texts(df, A, B)
    assert out.columns == ["row", "text", "a.b", *alignment.ADDED]
    got = out.first()
    assert (got["row"], got["a.b"], got["n_a"], got["groups"]) == ("k", 6, by_hand("some text")[0], by_hand("some text")[2])


def test_long_texts(spark):
    ship(spark)
    r = random.Random(5)
    docs = [(1, " ".join(some_texts(800, 7))), (2, "".join(r.choice("abcdeé") for _ in range(20_000)))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert as_rows(alignment.align_corpus(df, A, B)) == sorted(brute_force(docs), key=repr)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" aeé\t\n'x.1<s>|▁日"), st.characters(codec="utf-8")), max_size=30), max_size=4))
def test_any_text(texts):
    x = alignment.align(alignment.pair_for(A, B), texts)
    strings = alignment.group_strings(x)
    doc, key, times = alignment.linked_pairs(x, 50_256, PIECES.get_piece_size())
    for k, t in enumerate(texts):
        n_a, n_b, groups, links = by_hand(t)
        assert strings[k].decode() == groups and (x.a_doc == k).sum() == n_a and (x.b_doc == k).sum() == n_b
        got = {divmod(int(p), PIECES.get_piece_size()): int(m) for p, m in zip(key[doc == k], times[doc == k])}
        assert got == dict(links)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 400)), st.sets(st.integers(1, 400))), min_size=1, max_size=4))
def test_shared_cuts_are_all_found(texts):
    """Ends that are far apart, nested or without any shared one."""
    a, b, first, last, base = [], [], [], [], 0
    for x, y in texts:
        first.append(len(a))
        a += [base + v for v in sorted(x | {401})]
        b += [base + v for v in sorted(y | {401})]
        last.append(len(a) - 1)
        base += 401
    a, b = np.array(a), np.array(b)
    assert alignment.shared_cuts(a, b, np.array(first), np.array(last)).tolist() == np.isin(a, b).tolist()


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(0, 2**40), st.integers(1, 2**31), min_size=1))
def test_packing_is_exact(pairs):
    key, times = np.array(sorted(pairs), np.int64), np.array([pairs[k] for k in sorted(pairs)], np.int64)
    k, t = alignment.unpacked(alignment.packed(key, times))
    assert k.tolist() == key.tolist() and t.tolist() == times.tolist()
