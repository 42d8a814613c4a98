"""op11: source divergence audit against a direct reading of the contract."""

import re
from collections import Counter, defaultdict

from plumbline.llm import divergence

DOCS = "doc_id bigint, text string, lang string, source string, term string, count bigint, p bigint, rank int"


def brute(rows, least_docs, top=10):
    """The contract read literally: dense over all kept terms and all pairs of sources."""
    docs = []
    for text, lang, source in rows:
        text = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        docs.append((lang or "", source or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text)))
    df, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, terms in docs:
        groups.add((lang, source))
        df[lang].update(set(terms))
        counts[(lang, source)].update(terms)
    kept = {lang: sorted(t for t, n in c.items() if n >= least_docs) for lang, c in df.items()}

    def p(counter, lang):
        v = len(kept[lang])
        n = sum(counter[t] for t in kept[lang])
        return {t: 1 + 10**9 * (counter[t] + 2) // (n + 2 * v) for t in kept[lang]}

    f = lambda a, b: (a - b) ** 2 // (a + b)
    out = []
    for lang in kept:
        whole = Counter()
        for (g, _), c in counts.items():
            if g == lang:
                whole.update(c)
        q_lang = p(whole, lang)
        sources = sorted(s for g, s in groups if g == lang)
        for s in sources:
            ps = p(counts[(lang, s)], lang)
            pairs = [(t, sum(f(ps[x], p(counts[(lang, t)], lang)[x]) for x in kept[lang])) for t in sources if t != s]
            terms = [(x, f(ps[x], q_lang[x])) for x in kept[lang] if counts[(lang, s)][x] > 0 and ps[x] > q_lang[x]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda iv: (-iv[1], iv[0].encode()))
                for r, (item, value) in enumerate(ranked[:limit], 1):
                    out.append((lang, s, part, item, value, r))
    return sorted(out)


def test_audit_matches_brute_force_on_awkward_rows(spark):
    texts = [
        ("Apple apple pie; APPLE tart, pie", "en", "a"),
        ("apple pie pie pie", "en", "a"),
        ("apple pie pie pie", "en", "a"),  # a repeated row counts twice
        ("apple tart", "en", "b"),
        ("Über über straße ünï", "en", "b"),
        ("tart tart tart apple", "en", "c"),
        (None, "en", "c"),
        ("", None, None),
        ("apple", None, None),
        ("apple", None, "d"),
        ("x1y 22 q@r", "de", "a"),
        ("solo", "fr", "only"),  # one source: no pair rows
        ("nothing kept here", "es", "a"),
        ("unrelated words", "es", "b"),  # es keeps no term at 2: values 0
        ("long " * 20_000, "en", "c"),
    ]
    rows = [(i, t, lang, s, "clash", 1, 2, 3) for i, (t, lang, s) in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    got = sorted(tuple(r) for r in divergence.audit(df, least_docs=2).collect())
    assert got == brute(texts, 2)
    assert any(r[2] == "pair" and r[0] == "es" and r[4] == 0 for r in got)
    assert not any(r[0] == "fr" and r[2] == "pair" for r in got)


def test_audit_on_many_sources_keeps_ten_terms(spark):
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(6)]
    texts = []
    for k in range(60):
        picked = [words[(k * 7 + j * j) % len(words)] for j in range(12)]
        texts.append((" ".join(picked), "en", f"s{k % 4}"))
    rows = [(i, t, lang, s, None, None, None, None) for i, (t, lang, s) in enumerate(texts)]
    got = sorted(tuple(r) for r in divergence.audit(spark.createDataFrame(rows, DOCS), least_docs=3).collect())
    assert got == brute(texts, 3)
    assert max(r[5] for r in got if r[2] == "term") <= 10


def test_audit_of_an_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0



def test_only_a_to_z_are_lower_cased(spark):
    # ASCII texts take lower(), others translate(): É and Ω keep their case either way.
    texts = ["ÉCOLE École", "Word WORD", "ΩMEGA ωmega"]
    rows = [(i, t, "xx", "s", None, None, None, None) for i, t in enumerate(texts)]
    counts = divergence.term_counts(spark.createDataFrame(rows, DOCS), least_docs=1).collect()
    got = {(r["term"], r["count"]) for r in counts}
    assert got == {("École", 2), ("word", 2), ("Ωmega", 1), ("ωmega", 1)}


def test_kept_terms_cross_one_shuffle_and_are_stored_once(spark, monkeypatch):
    rows = [("one two", "en", s) for s in ("a", "a", "b")] + [("two three", "en", None), ("two", "de", "a"), (None, "en", "c")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    store, plans = divergence.stored, {}

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return store(df, name)

    monkeypatch.setattr(divergence, "stored", noted)
    kept = divergence.term_counts(docs, 3)
    assert {tuple(r) for r in kept.collect()} == {
        ("en", "a", "one", 2, 2), ("en", "b", "one", 1, 1),
        ("en", "a", "two", 2, 2), ("en", "b", "two", 1, 1), ("en", "", "two", 1, 1),
    }
    assert list(plans) == ["divergence_kept"] and "LeftSemi" not in plans["divergence_kept"]
