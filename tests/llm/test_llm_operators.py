"""Each training-data operator against brute force on small and awkward tables."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plumbline.llm import (
    chat_format,
    decontaminate,
    html_extract,
    line_dedup,
    mixing,
    pii,
    quality,
    queries,
    simhash,
    token_files,
    toxicity,
)
from plumbline.llm.repair import Expander, compress
from plumbline.llm.text_stats import base_statistics, repeated_words
from plumbline.llm.word_tokens import WordEncoder
from plumbline.settings import scratch_path

SF = "/root/testdata/sf0.001"
LONG = "long word " * 30_000
DOCS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "kept boolean, score double, fp bigint, row bigint, size bigint, h bigint"
)


def awkward(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing names."""
    texts = [
        (1, "The cat sat, on the mat.\nThe cat sat, on the mat.\nmail a.b@c.de now", "en", "a"),
        (1, "The cat sat, on the mat.\nThe cat sat, on the mat.\nmail a.b@c.de now", "en", "a"),
        (2, None, None, None),
        (3, "", "en", ""),
        (None, "no id here +1 (437) 555-0689 and 4111 1111 1111 1111", "de", "b"),
        (4, LONG, "fr", "a"),
        (5, " \n\t\n ", None, "b"),
        (6, "ünïcode 日本語 \x01 　 <|endoftext|> don't", "xx", None),
        (7, LONG + "x", "fr", "a"),
    ]
    rows = [(*t, None, True, 1.0, 1, 2, 3, 4) for t in texts]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def real(spark, name="documents"):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# --- 1: personal data ---------------------------------------------------------------------


def brute_spans(text):
    def luhn(x):
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(x[::-1])]
        return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0

    def digits(m):
        return re.sub("[^0-9]", "", m.group())

    email = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
    found = [("email", m) for m in re.finditer(email, text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) < 256 for p in m.group().split(".")):
            found.append(("ip", m))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 13 <= len(digits(m)) <= 19 and luhn(digits(m)):
            found.append(("card", m))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m)) <= 15:
            found.append(("phone", m))
    return [f"{k}:{m.start()}:{m.end()}" for k, m in found]


@pytest.mark.parametrize(
    "text",
    [
        "a@b@c.com x@y.z@w.v @q.r",
        "1.2.3.4.5.6.7.8 0001.2.3.999 12.34.56.78.",
        "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111",
        "+1 (437) 555-0689 ++12345678 +1-2",
        "a..b@-.c a@b. %@x.y",
        "",
    ],
)
def test_base_patterns(text):
    assert pii._written(pii.base_spans(text)).split(",") == (brute_spans(text) or [""])


def test_personal_data_on_real_and_awkward_rows(spark):
    for docs in (real(spark), awkward(spark)):
        out = pii.personal_data(docs)
        assert out.columns == [*docs.columns, "personal_data"]
        for r in out.collect():
            base = brute_spans(r.text or "")
            assert r.personal_data.base == ",".join(base)
            assert set(base) <= set(r.personal_data.spans.split(",")) | {""}
    assert pii.report(empty(spark)).count() == 0


def test_messages_are_exact_on_a_tree():
    rng = np.random.default_rng(1)
    unary, pots = rng.random((3, 2)) + 0.1, rng.random((2, 2, 2)) + 0.1
    edges = np.array([[0, 1], [1, 2]])
    joint = np.einsum("a,b,c,ab,bc->abc", *unary, *pots)
    joint /= joint.sum()
    expected = [joint.sum((1, 2)), joint.sum((0, 2)), joint.sum((0, 1))]
    assert np.allclose(pii.pass_messages(unary, edges, pots, rounds=200), expected, atol=1e-3)


def test_a_repeated_number_gets_the_label_of_its_full_form(spark):
    field = pii.fit(real(spark))
    strong = pii.Field(field.weights * 0.05, field.step, np.where(np.eye(5) > 0, 50.0, 0.5))
    text = "+1 (437) 555-0689 is it, and " + "word " * 40 + "again 555-0689 yes"
    found = pii.added_spans(strong, pii.Gap(strong.step, pii._PLAIN), text, pii.base_spans(text))
    assert (3, text.rindex("555"), text.rindex("555") + 8) in found


def test_a_lone_token_meets_the_field():
    text = "only 12345 here"
    weights = np.zeros((72, 5))
    # Each token has the constant feature: the weight makes kind 0 likely for any.
    weights[23, 1] = 9
    field = pii.Field(weights, np.ones((5, 5)), np.ones((5, 5)))
    assert pii.added_spans(field, pii.Gap(field.step, pii._PLAIN), text, []) == [(0, 5, 10)]
    assert pii.added_spans(field, pii.Gap(field.step, pii._PLAIN), "none", []) == []
    assert pii.added_spans(field, pii.Gap(field.step, pii._PLAIN), text, [(0, 5, 10)]) == []


# --- 2: mixing -----------------------------------------------------------------------------


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, target, free = sum(sizes.values()), {}, set(names)
    while free:
        rest = total - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        target |= {s: 3.0 * sizes[s] for s in over}
        free -= over
    return target


def test_mix_meets_its_targets(spark):
    docs = real(spark)
    rows = mixing.mix_report(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    target = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken % max(r.size, 1) == 0 and r.taken <= 3 * r.size
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1
    again = mixing.mix_report(docs.repartition(5)).collect()
    assert sorted(again) == sorted(mixing.mix_report(docs).collect())


def test_tree_keeps_quotas_and_halves(spark):
    quotas = spark.createDataFrame([("a", 5000), ("b", 3000), (None, 37), ("c", 0)], "source string, quota bigint")
    rows = mixing.splitting_tree(quotas, 3).collect()
    assert Counter() + Counter({k: v for k, v in [("a", 5000), ("b", 3000), (None, 37)]}) == sum(
        (Counter({r.source: r.blocks}) for r in rows), Counter()
    )
    shards = sum((Counter({r.shard: r.blocks}) for r in rows), Counter())
    assert max(shards.values()) - min(shards.values()) <= 1
    for s in ("a", "b", None):
        own = sorted((r["first"], r.blocks) for r in rows if r.source == s)
        assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))


def test_draw_is_hypergeometric(spark):
    big = lambda n: F.lit(n).cast("bigint")
    draw = mixing._drawn(big(60), big(18), big(25), mixing._uniform(F.lit(1), F.col("id")))
    mean, spread = spark.range(4000).select(draw.alias("x")).agg(F.avg("x"), F.var_pop("x")).first()
    assert mean == pytest.approx(7.5, abs=0.15) and spread == pytest.approx(3.114, abs=0.35)


def test_mix_of_awkward_rows(spark):
    docs = awkward(spark)
    assert mixing.mix_report(docs).count() == docs.count()
    assert mixing.mixed(docs).columns == docs.columns and mixing.mixed(docs).count() > 0
    assert mixing.mix_report(empty(spark)).count() == 0 and mixing.mixed(empty(spark)).count() == 0


# --- 3: chats ------------------------------------------------------------------------------


@pytest.mark.parametrize("text", ["<|", "<\\|", "a<\\\\|b<<||", "", "\\", "<|im_end|>\n<|im_start|>user\n"])
def test_template_is_reversible(text):
    piece = chat_format.formatted("ro\nle\\n<|", text)[0]
    assert "<|" not in chat_format.escaped(text)
    assert chat_format.parsed(piece) == ("ro\nle\\n<|", text)


def test_layouts_are_told_by_their_fields():
    turns = chat_format.canonical_turns
    assert turns({"instruction": "a", "input": "b", "output": "c", "id": 3}) == [("user", "a\n\nb"), ("assistant", "c")]
    assert turns({"instruction": "a", "output": "c"}) == [("user", "a"), ("assistant", "c")]
    share = {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "z"}], "m": {"x": [1]}}
    assert turns(share) == [("user", "q"), ("assistant", "z")]
    assert turns({"messages": [{"role": "user", "content": "x"}]}) == [("user", "x")]
    assert turns({"foo": 1}) is None and turns(None) is None and turns([1]) is None


def test_chats_read_back(spark):
    rows = real(spark, "conversations")
    expected = defaultdict(list)
    for r in rows.collect():
        expected[r.conv_id].append((r.turn, r.role, r.text or ""))
    text = "<|im_end|><|im_start|>assistant ok"
    expected[-1] = [(0, "user", text), (1, "assistant", text)]
    got = {r.conv_id: r for r in queries.op3_chat_format(spark, SF).collect()}
    assert got.keys() == expected.keys()
    for conv, turns in expected.items():
        turns.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        learned = "".join(text for _, role, text in turns if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(learned))
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()


def test_awkward_chats(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (None, None, "user", "x"), (2, 5, "assistant", LONG)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r for r in chat_format.read_chats(chat_format.format_records(chat_format.rows_as_records(df))).collect()}
    assert got[1].n_turns == 2 and got[None].n_turns == 1 and got[2].loss_chars == len(LONG)
    assert chat_format.read_chats(chat_format.format_records(chat_format.rows_as_records(df.limit(0)))).count() == 0
    odd = spark.createDataFrame([(1, 0, "{bad"), (2, 0, None), (3, 0, '{"q": 1}')], "conv_id int, turn int, record string")
    assert [r.piece for r in chat_format.format_records(odd).collect()] == [None] * 3


# --- 4: pages ------------------------------------------------------------------------------


def test_pages_of_the_table(spark):
    for r in html_extract.extract(real(spark, "pages")).join(real(spark, "pages"), ["page_id", "url"]).collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S).group(1).replace("<br>", " ")
        blocks = [" ".join(__import__("html").unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == " ".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_other_pages():
    page = (
        '<html><body class="has-sidebar"><header><h1>Site</h1></header><nav><a href=x>m</a></nav><div id=wrap>'
        '<div class="sidebar"><p>Side text, with, commas, and, more, words here.</p></div><div class="content">'
        "<h1>T &amp; x</h1><p>One, two, three four five six seven, eight.</p><form><input><p>form, text</p></form>"
        "<div class=notice>We use cookies</div><p>Second<b>ary</b> para\n graph, with text<br>more."
        '<script>var a="<p>no</p>"</script><ul><li>a<li>b &lt;c&gt;</ul></div><section id="comments">'
        "<p>Reader says, hi, there, lots, of, commas.</p></section></div><footer>foot</footer>"
    )
    text = "T & x One, two, three four five six seven, eight. Secondary para graph, with text more. a b <c>"
    assert html_extract.main_text(page) == text
    assert html_extract.main_text("") == "" and html_extract.main_text("just text") == "just text"
    assert html_extract.main_text("<div>" * 20_000 + "deep, text here") == "deep, text here"
    assert html_extract.main_text("<" * 50_000).startswith("<")


def test_uneven_sections_and_short_paragraphs_are_kept():
    long = "a, b, c, " + "word " * 78 + "."
    flat = " ".join(long.split())
    sections = f"<section>{f'<p>{long}</p>' * 4}</section><section><h2>Next</h2><p>{long}</p></section>"
    text = " ".join([flat] * 4 + ["Next", flat])
    link = "<a href=x>Home page</a>"
    for page in (
        f"<body><div>{link}</div><article>{sections}<div><p>End.</p></div></article>",
        f"<body><div class=page><div>{sections}</div><div><div><p>End.</p></div></div></div>{link}",
        f"<body>{link}<div><div><div>{sections}</div></div><div>{link}</div></div><p>End.</p>",
        f"<body><main><div>{sections}</div>End.</main><p>{link}</p>",
    ):
        assert html_extract.main_text(page) == text + " End."


def test_awkward_pages(spark):
    df = spark.createDataFrame([(1, "u", None), (None, None, ""), (2, "v", "<p>a, b</p>")], "page_id int, url string, html string")
    assert [(r.text, r.n_chars) for r in html_extract.extract(df).collect()] == [("", 0), ("", 0), ("a, b", 4)]
    assert html_extract.extract(df.limit(0)).count() == 0


# --- 5: contamination -----------------------------------------------------------------------


def test_blocks_of_the_benchmark_agree(spark):
    docs, bench = real(spark), real(spark, "benchmark")
    one = decontaminate.scanned(docs, bench).select("doc_id", "contamination").orderBy("doc_id").collect()
    many = decontaminate.scanned(docs, bench, block_bytes=1500).select("doc_id", "contamination").orderBy("doc_id")
    assert one == many.collect()


def test_spans_and_documents_are_removed(spark):
    words = [f"w{i}" for i in range(40)]
    bench = spark.createDataFrame([(1, " ".join(words[:20])), (2, "Zed"), (None, "null item"), (3, None)], "item_id int, text string")
    docs = spark.createDataFrame(
        [
            (1, "Intro! " + " ".join(words[2:17]).upper() + ", end.", 0),
            (2, "x " * 30 + "zed", 0),
            (3, None, 0),
            (4, " ".join(words[:12]), 0),
            (5, "a null item", 0),
        ],
        "doc_id int, text string, contamination int",
    )
    got = {r.doc_id: r for r in decontaminate.report(docs, bench).collect()}
    assert [(got[i].n_hit, got[i].n_items, got[i].contaminated) for i in range(1, 6)] == [
        (15, 1, True),
        (1, 1, False),
        (0, 0, False),
        (0, 0, False),
        (2, 0, True),
    ]
    assert [r.doc_id for r in decontaminate.keep_clean(docs, bench).orderBy("doc_id").collect()] == [2, 3, 4]
    cut = {r.doc_id: r.text for r in decontaminate.cut_spans(docs, bench).select("doc_id", "text").collect()}
    assert cut[1] == "Intro! , end." and cut[3] is None
    assert decontaminate.report(docs.limit(0), bench).count() == 0
    assert decontaminate.report(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.report(awkward(spark), bench).count() == 9


# --- 6: toxicity -----------------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    tagger = toxicity.fit(docs, labels, ~toxicity.held_out())
    test = labels.where(toxicity.held_out()).join(docs, "doc_id").where(F.length("text") < 8000)
    rows = test.select("toxic", toxicity._tag(tagger)("text").alias("t")).collect()
    right = sum(r.toxic == r.t.predicted for r in rows)
    assert right / len(rows) > 0.97
    caught = [r.t.predicted for r in rows if r.toxic]
    assert sum(caught) / len(caught) > 0.85


def test_awkward_texts_have_scores(spark):
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 1), (4, None, None), (6, 0, 1)], "doc_id int, quality int, toxic int")
    for lab in (labels, labels.limit(0)):
        out = toxicity.toxicity(awkward(spark), lab, F.lit(True)).collect()
        assert len(out) == 9 and all(0 <= r.toxicity.score <= 1 for r in out)
    assert toxicity.toxicity(empty(spark), labels, F.lit(True)).count() == 0


def test_summed_out_gaps_are_exact():
    rng = np.random.default_rng(2)
    step, plain, hit = rng.random((2, 2)) + 0.1, rng.random(2) + 0.1, rng.random(2) + 0.1
    from plumbline.llm.chains import Gap, forward_backward

    whole = forward_backward(np.array([hit, plain, plain, plain, hit]), np.array([step] * 4))
    short = forward_backward(np.array([hit, hit]), Gap(step, plain)(np.array([3])))
    assert np.allclose(whole[[0, 4]], short)


def test_words_before_and_after_the_hits_are_summed_out():
    from plumbline.llm.chains import Gap, forward_backward

    rng = np.random.default_rng(5)
    unary, trans = rng.normal(size=(3, 2)), rng.normal(size=(2, 2))
    tagger = toxicity.Tagger({}, unary, trans, np.zeros(3))
    gap = Gap(np.exp(trans), np.exp(unary[0]))
    for kind in ([0, 0, 1, 0, 2, 0, 0, 0], [1, 0, 0], [0, 0, 2], [0, 1, 0], [1, 0, 2], [1], [0, 2, 1, 0]):
        kind = np.array(kind)
        at = np.flatnonzero(kind)
        whole = forward_backward(np.exp(unary[kind]), np.array([np.exp(trans)] * (len(kind) - 1)))
        assert np.allclose(toxicity._marginals(tagger, gap, at, kind[at], len(kind)), whole[at, 1])


# --- 7: token files --------------------------------------------------------------------------


def plain_ids(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_files_hold_the_tokenizers_ids(spark):
    docs = awkward(spark).unionByName(real(spark).limit(60), allowMissingColumns=True)
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    got = token_files.read_tokens(spark, path).orderBy("start").collect()
    key = lambda r: (r.doc_id is not None, r.doc_id or 0)
    assert [r.doc_id for r in got] == [r.doc_id for r in sorted(docs.collect(), key=key)]
    starts = np.cumsum([0, *(r.n_tokens for r in got)])
    assert [r.start for r in got] == starts[:-1].tolist()
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (r.doc_id, len(ids), crc(ids)) for r in docs.collect() for ids in [plain_ids(r.text)]
    )


def test_no_rows_no_blocks(spark):
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(empty(spark), path, public_tokenizers.path("word_bpe_49k.json"))
    assert token_files.read_tokens(spark, path).count() == 0


def test_words_one_by_one_are_the_whole_text():
    spec = open(public_tokenizers.path("word_bpe_49k.json")).read()
    text = "áb ́x IΣ foo\x1cbar x y don't I'LL <|endoftext|> ５ ﬁ a\tb it's'll \x01 a\x01b \ń q 12ab ß.De #*! İ ŉ"
    assert np.frombuffer(WordEncoder(spec).encode([text.encode()])[0], "<u2").tolist() == plain_ids(text)[:-1]


def test_a_full_memory_keeps_the_words_at_hand(monkeypatch):
    spec = open(public_tokenizers.path("word_bpe_49k.json")).read()
    encoder, learned = WordEncoder(spec, remember=8), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda words: learn(learned.append(sorted(words)) or learned[-1]))
    texts = ["ab cd ef's gh (é) ab", "cd x1 ab, ab kl mn op", "x1 cd ab"]
    for text in texts:
        assert np.frombuffer(encoder.encode([text.encode()])[0], "<u2").tolist() == plain_ids(text)[:-1]
    # the second text overflows the memory; of the first one it takes over what it holds itself
    assert learned[1] == [b"ab,", b"kl", b"mn", b"op", b"x1"] and learned[2] == []


def test_a_word_is_looked_up_once_for_many_occurrences():
    asked = []

    class Known(dict):
        def __contains__(self, word):
            return asked.append(word) or super().__contains__(word)

        def __getitem__(self, word):
            return asked.append(word) or super().__getitem__(word)

    encoder = WordEncoder(open(public_tokenizers.path("word_bpe_49k.json")).read())
    encoder.known = Known(encoder.known)
    texts = ["ab, Cd ef's\t" * 500, "", " ", "\x0bcd\x1cé É. é." * 300]
    got = [np.frombuffer(ids, "<u2").tolist() for ids in encoder.encode([t.encode() for t in texts])]
    assert got == [plain_ids(t)[:-1] for t in texts]
    assert len(asked) < 50


def test_words_are_encoded_on_one_core(monkeypatch):
    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "true")
    WordEncoder(open(public_tokenizers.path("word_bpe_49k.json")).read())
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(3)
    ids = np.concatenate([np.tile(rng.integers(0, 50, 40), 60), rng.integers(0, 49_408, 500), np.tile([7], 300)])
    counts = np.array([0, 1000, 1, 0, 1199, 500, 500, 0])
    g = compress(ids.astype(np.uint16), counts)
    expand = Expander(g.rules, g.lengths)
    assert expand(g.symbols).tolist() == ids.tolist() and len(g.symbols) < 0.6 * len(ids)
    assert len(g.rules) and (expand.length[49_408 : 49_408 + len(g.rules)] == g.lengths).all()
    ends, stops = np.cumsum(g.counts), np.cumsum(counts)
    for k in range(len(counts)):
        own = g.symbols[ends[k] - g.counts[k] : ends[k]]
        assert expand(own).tolist() == ids[stops[k] - counts[k] : stops[k]].tolist()
    assert [expand.token(g.symbols, p) for p in (0, 999, 1000, 3199)] == [ids[p] for p in (0, 999, 1000, 3199)]


def test_pairs_are_replaced_until_none_is_frequent():
    rng = np.random.default_rng(4)
    # Copies of one document, runs of one id of odd and even length, noise over few ids.
    runs = [np.append(np.repeat(9, k), 10 + k) for k in range(1, 40)] * 3
    docs = [np.append(rng.integers(3, 40_000, 350), 2)] * 600 + runs + [rng.integers(3, 30, 3000), np.repeat(7, 5001)]
    ids, counts = np.concatenate(docs), np.array([len(d) for d in docs])
    g = compress(ids.astype(np.uint16), counts)
    expand = Expander(g.rules, g.lengths)
    assert expand(g.symbols).tolist() == ids.tolist()
    assert g.lengths.max() >= 351 and (g.rules[:, 0] == g.rules[:, 1]).any() and (g.counts[:600] == 1).all()
    left = Counter()
    at = 0
    for size in g.counts.tolist():
        own = g.symbols[at : at + size].tolist()
        at += size
        # Pairs of equal symbols are counted from the left, without overlap.
        for i, (a, b) in enumerate(zip(own, own[1:])):
            run = next((k for k in range(i + 1) if own[i - k] != a), i + 1) if a == b else 1
            left[a, b] += run % 2
    assert max(left.values(), default=0) < 12


# --- 8: quality ------------------------------------------------------------------------------


def brute_repeats(words, window=8):
    seen = defaultdict(list)
    for i in range(len(words) - window + 1):
        seen[tuple(words[i : i + window])].append(i)
    return len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(window)})


def test_repeated_windows_against_brute_force():
    rng = np.random.default_rng(4)
    for n in (0, 5, 8, 9, 40, 200):
        for kinds in (1, 2, 3, 8):
            words = [b"w%d" % i for i in rng.integers(0, kinds, n)]
            assert repeated_words(words) == brute_repeats(words)


def test_base_statistics_against_brute_force(spark):
    for r in [*real(spark).collect(), *awkward(spark).where("doc_id <> 4 and doc_id <> 7").collect()]:
        text = r.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        n, chars, symbols, dup, repeat, *_ = base_statistics(text.encode())
        assert (n, chars) == (len(words), sum(map(len, words)))
        assert symbols == len(re.findall(r"[#*$%&|<>]", text)) and dup == len(lines) - len(set(lines))
        assert repeat == brute_repeats(words)


def test_quality_verdicts(spark):
    docs, labels = real(spark), real(spark, "labels")
    rows = quality.quality_rules(docs, labels).join(labels, "doc_id").select("quality", "quality_verdict.*").collect()
    judged = [r for r in rows if not r.base_failed]
    assert sum(r.kept == (r.quality == 1) for r in judged) / len(judged) > 0.95
    assert all(not r.kept for r in rows if r.base_failed)
    for lab in (labels, labels.limit(0)):
        assert quality.quality_rules(awkward(spark), lab).count() == 9
        assert quality.keep_good(empty(spark), lab).columns == empty(spark).columns


def test_trees_are_monotonic():
    rng = np.random.default_rng(5)
    x = rng.random((600, 3))
    y = (x[:, 0] - 0.6 * x[:, 1] + 0.3 * np.sin(9 * x[:, 2]) + 0.3 * rng.random(600) > 0.35).astype(float)
    trees = quality.fit_trees(x, y, np.array([1, -1, 0]))
    grid = np.repeat(rng.random((50, 3)), 20, axis=0).reshape(50, 20, 3)
    for column, sign in ((0, 1), (1, -1)):
        moved = grid.copy()
        moved[:, :, column] = np.linspace(0, 1, 20)
        score = trees.score(moved.reshape(-1, 3)).reshape(50, 20)
        assert (sign * np.diff(score, axis=1) >= -1e-12).all()
    assert ((trees.score(x) > 0.5) == y).mean() > 0.8


# --- 9: lines --------------------------------------------------------------------------------


def test_lines_against_all_pairs(spark):
    docs = real(spark).where("doc_id < 120")
    lines = [(r.doc_id, i, x) for r in docs.orderBy("doc_id").collect() for i, x in enumerate(r.text.split("\n")) if x.strip()]
    names = list(dict.fromkeys(x for *_, x in lines))
    sets, owners, root = [line_dedup.shingles(x) for x in names], defaultdict(list), list(range(len(names)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for j, own in enumerate(sets):
        for i, both in Counter(i for g in own for i in owners[g]).items():
            if both >= 0.8 * (len(sets[i]) + len(own) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for g in own:
            owners[g].append(j)
    number, seen, gone = {x: i for i, x in enumerate(names)}, set(), defaultdict(list)
    for d, i, x in lines:
        if find(number[x]) in seen:
            gone[d].append(i)
        seen.add(find(number[x]))
    assert {r.doc_id: r.removed for r in line_dedup.report(docs).collect() if r.removed} == gone


def test_awkward_lines(spark):
    got = line_dedup.report(awkward(spark)).collect()
    assert len(got) == 9 and sum(r.n_removed for r in got if r.doc_id == 1) == 4
    assert sum(r.n_removed for r in got if r.doc_id in (4, 7)) == 1
    out = line_dedup.dedup_lines(awkward(spark))
    assert out.columns == awkward(spark).columns
    assert Counter(r.text for r in out.where("doc_id = 1").collect()).total() == 2
    assert line_dedup.report(empty(spark)).count() == 0


# --- 10: SimHash -----------------------------------------------------------------------------


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_all_pairs(spark):
    rows = [(r.doc_id, brute_print(r.text)) for r in real(spark).collect()]
    # A chain of prints two bits apart, whose ends are far from each other.
    prints = np.array([p for _, p in rows], np.uint64)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 3).tolist():
            a, b = sorted((find(i), find(j)))
            root[b] = a
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    expected = {d: (f"{p:016x}", least[find(i)]) for i, (d, p) in enumerate(rows)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(real(spark)).collect()}
    assert got == expected


def test_links_of_dense_prints(spark):
    rng = np.random.default_rng(6)
    centre = int(rng.integers(0, 2**62))
    prints = {centre ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 4), replace=False)) for _ in range(400)}
    prints |= set(rng.integers(0, 2**62, 50).tolist())
    df = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    from plumbline.llm.components import components

    links = simhash.fingerprint_links(df)
    for a, b in links.collect():
        assert bin(a ^ b).count("1") <= 3
    own = np.array(sorted(prints))
    left, classes = set(range(len(own))), []
    while left:
        todo, group = [left.pop()], set()
        while todo:
            i = todo.pop()
            group.add(int(own[i]))
            near = [j for j in left if bin(int(own[i]) ^ int(own[j])).count("1") <= 3]
            left -= set(near)
            todo += near
        classes.append(group)
    got = {r.node: r.root for r in components(links).collect()}
    for group in classes:
        assert {got.get(p, p) for p in group} == {min(group)}


def test_awkward_documents(spark):
    got = simhash.near_duplicates(awkward(spark)).collect()
    assert len(got) == 9
    assert {r.component_id for r in got if r.doc_id in (2, 3, 5)} == {2}
    one = simhash.keep_one(awkward(spark))
    assert one.columns == awkward(spark).columns
    assert sorted(r.doc_id or 0 for r in one.collect())[:3] == [0, 1, 2] and one.where("doc_id = 1").count() == 1
    assert simhash.near_duplicates(empty(spark)).count() == 0 and simhash.keep_one(empty(spark)).count() == 0


def test_large_buckets_are_cut_into_cells(spark):
    from plumbline.llm.links import bucket_links

    df = spark.range(300).select(F.lit(1).alias("b"), "id", F.col("id").alias("v"))
    near = lambda cell: lambda i, others: np.abs(cell["v"][others] - cell["v"][i]) <= 1
    from plumbline.llm.components import components

    links = bucket_links(df, ["b"], "id", ["v"], near, cell=40)
    assert {r.root for r in components(links).collect()} == {0}


def test_shingles_as_numbers_link_as_shingles_do():
    rnd = random.Random(9)
    for chars in ("abc dÄÿ ", "ab日 c", "ab\0c"):
        base = ["".join(rnd.choices(chars, k=rnd.choice([3, 8, 60, 300]))) for _ in range(30)]
        lines = base + ["".join(rnd.choice(chars) if rnd.random() < 0.01 else c for c in b) for b in base for _ in (1, 2)]
        near, others = line_dedup._near({"line": lines}), np.arange(len(lines))
        sets = [line_dedup.shingles(line) for line in lines]
        for i, own in enumerate(sets):
            brute = [len(own & s) >= line_dedup.SIMILAR * len(own | s) for s in sets]
            assert near(i, others).tolist() == brute
    assert line_dedup._near_latin(["abcdefgh"])(0, np.arange(0)).tolist() == []


def test_two_lines_are_compared_by_one_sort(monkeypatch):
    lines = ["abc dä " * 40, "abc dä " * 39 + "xyz", "other words " * 30]
    near = line_dedup._near({"line": lines})
    monkeypatch.setattr(np, "searchsorted", lambda *_: 1 / 0)
    sets = [line_dedup.shingles(line) for line in lines]
    for i, own in enumerate(sets):
        assert near(i, np.arange(3)).tolist() == [len(own & s) >= line_dedup.SIMILAR * len(own | s) for s in sets]


def test_sketches_are_made_a_few_lines_at_a_time(monkeypatch):
    rnd, most = random.Random(11), []
    lines = ["".join(rnd.choices("ab dÄ日\0", k=rnd.choice([1, 8, 9, 90, 900]))) for _ in range(400)]
    lines[7] = lines[8] = lines[9] = "long " * 20_000
    least = line_dedup._least
    monkeypatch.setattr(line_dedup, "_least", lambda texts: most.append(sum(map(len, texts))) or least(texts))
    keys = line_dedup.bands(lines)
    assert len(most) > 5 and sorted(most)[-4] < 1 << 17
    for k in (0, 7, 8, 200, 399):
        assert (line_dedup.bands([lines[k]])[0] == keys[k]).all()
    # a slot's least hash, shingle by shingle
    text, top, wrap = "some Words and more", (1 << 64) - 1, 1 << 64
    want = [top] * 32
    for i in range(len(text) - 7):
        h = 0
        for c in text[i : i + 8]:
            h = (h * 0x9E3779B97F4A7C15 + ord(c)) % wrap
        h = (h ^ h >> 31) * 0xBF58476D1CE4E5B9 % wrap
        h = (h ^ h >> 29) * 0x94D049BB133111EB % wrap
        h ^= h >> 32
        want[h >> 59] = min(want[h >> 59], h)
    assert least(["x" * 9, text, "y" * 9])[1].tolist() == want
