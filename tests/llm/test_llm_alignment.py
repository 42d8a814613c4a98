"""op12: cross-tokenizer alignment against a literal reading of the contract."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from plumbline.llm import token_alignment as T

DOCS = "doc_id bigint, text string, pairs string, _row bigint, a bigint, n_a bigint"
TEXTS = [
    "Hello world, hello again.",
    "Hello world, hello again.",
    "Der Bär ging über die Straße.\nZweite Zeile\twith tab",
    "two  spaces and <|endoftext|> inside <s> and </s>",
    "café Ⅳ 日本語のテキスト 🙂 emoji",
    "x" * 3000,
    ("word " * 4000).strip(),
    " leading space",
    "trailing space ",
    "a\r\nb\x00c",
    "",
    None,
    "12345 678.90 $%&*",
]


def brute(texts):
    a = Tokenizer.from_file(public_tokenizers.path(T.A_FILE))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(T.B_FILE))
    alphabet = T._byte_level()
    a_bytes = lambda i: bytes(alphabet[c] for c in a.id_to_token(i))

    def b_bytes(i):
        p = b.id_to_piece(i)
        if p.startswith("<0x") and p.endswith(">") and len(p) == 6:
            return bytes([int(p[3:5], 16)])
        return p.replace("▁", " ").encode()

    docs = []
    for text in texts:
        if not text:
            docs.append(None)
            continue
        ai = a.encode(" " + text, add_special_tokens=False).ids
        bi = b.encode(text)
        ab, bb = [a_bytes(i) for i in ai], [b_bytes(i) for i in bi]
        target = (" " + text).encode()
        if b"".join(ab) != target or b"".join(bb) != target:
            docs.append(None)
            continue
        ends_a, ends_b, x = [], [], 0
        for t in ab:
            x += len(t)
            ends_a.append(x)
        x = 0
        for t in bb:
            x += len(t)
            ends_b.append(x)
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, ia, ib = [], 0, 0
        for c in cuts:
            ga, gb = [], []
            while ia < len(ai) and ends_a[ia] <= c:
                ga.append(ai[ia])
                ia += 1
            while ib < len(bi) and ends_b[ib] <= c:
                gb.append(bi[ib])
                ib += 1
            groups.append((ga, gb))
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        docs.append((len(ai), len(bi), groups, links))
    count = Counter(p for d in docs if d for p in set(d[3]))
    best = Counter()
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for i, d in enumerate(docs):
        if d is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        na, nb, groups, links = d
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((
            i, na, nb, len(groups), len(links),
            sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest(),
        ))
    return out


def test_alignment_matches_a_literal_reading(spark):
    df = spark.createDataFrame([(i, t, "clash", 9, 9, 9) for i, t in enumerate(TEXTS)], DOCS)
    got = sorted(tuple(r) for r in T.alignment(df).collect())
    assert got == sorted(brute(TEXTS))
    assert got[0][4] > 0 and got[-3][1] == 0


def test_alignment_of_an_empty_table(spark):
    assert T.alignment(spark.createDataFrame([], DOCS)).count() == 0


def _words(**limits):
    return T.Words(public_tokenizers.path(T.A_FILE), public_tokenizers.path(T.B_FILE), **limits)


def _rows(words, texts):
    sizes, digests, *pairs = words.align(texts)
    return sizes.tolist(), digests, *(p.tolist() for p in pairs)


def test_words_align_as_whole_texts_do():
    atoms = [
        " ", " ", "  ", "\n", "\t", "\r\n", "▁", "᠎", " ", "　", "\x1c", "​", "'s", "'", "***",
        "the", "Word", "Straße", "日本語", "🙂", "12", "Ⅳ", "</s>", "<|endoftext|>", "x" * 40, "\x00", ".", "!'s", "é",
    ]
    rnd = random.Random(12)
    texts = ["a " + "".join(rnd.choices(atoms, k=rnd.randint(0, 25))) for _ in range(3000)]
    whole = _words()
    whole.cuts = False
    expected = _rows(whole, texts)
    assert _rows(_words(), texts) == expected
    few = _words(remember=100, remember_chars=2_000)  # forgets again and again
    sizes, digests = [], []
    for i in range(0, len(texts), 50):
        got = _rows(few, texts[i : i + 50])
        sizes += got[0]
        digests += got[1]
    assert (sizes, digests) == expected[:2]
    assert "" in digests and any(digests)


def test_a_word_is_encoded_once():
    words = _words()
    seen = []
    tokens = words._tokens
    words._tokens = lambda lines: seen.extend(lines) or tokens(lines)
    texts = [f"the same words again and again, {i}" for i in range(500)]
    assert all(words.align(texts)[1])
    assert words.align(texts)[0][:, 0].min() > 7
    assert sum(map(len, seen)) < sum(map(len, texts)) / 4
