"""The corpus operators against brute force, and on awkward rows."""

import collections
import hashlib
import re

import numpy as np
import pytest

from orgkin.llm import (
    byte_bpe, html_text, jaccard_join, label_model, mixing, pii, posting_lists, quality_classifier,
    quality_rules, sentence_spans, toxicity,
)
from orgkin.llm.components import connected_components
from orgkin.llm.prefix_tree import PrefixTree

SMALL = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, words string"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").cache()


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty, blank, very long, repeated and extra columns with clashing names."""
    long = " ".join(f"w{i % 977} x{i}" for i in range(60_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", None, "a", 4), (4, long, "en", None, len(long)),
        (5, "same words here every time", "en", "a", 26), (6, "same words here every time", "en", "a", 26),
        (7, "two words", "de", "b", 9), (7, "two words", "de", "b", 9), (None, "no id", "en", "a", 5),
    ]
    return spark.createDataFrame([(*r, 1, 0.5, "x") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(awkward):
    return awkward.limit(0)


def test_bpe_is_tiktoken_and_round_trips(spark, documents, awkward):
    import public_tokenizers
    import tiktoken

    ranks = byte_bpe.read_ranks(byte_bpe.vocabulary())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for table in (documents.select("doc_id", "text"), awkward):
        want = collections.Counter()
        for r in table.collect():
            ids = library.encode_ordinary(r.text or "")
            want[r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                 hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
        assert collections.Counter(map(tuple, byte_bpe.digests(table).collect())) == want


def _jaccard(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize(("tokens", "members"), [(1_000_000, 4096), (1_500, 4096), (1_500, 3)])
def test_jaccard_components(documents, awkward, monkeypatch, tokens, members):
    monkeypatch.setattr(jaccard_join, "TREE_TOKENS", tokens)  # the smaller one splits blocks
    monkeypatch.setattr(jaccard_join, "MEMBERS", members)  # the smaller one leaves leaders whole
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(documents).collect()}
    assert found == _jaccard(rows, 4, 85)


def test_jaccard_awkward_rows(awkward, empty):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(awkward).collect()}
    assert found[6] == (2, 5) and found[7] == (1, 7) and found[3] == (0, 3) and found[None][1] is None
    kept = jaccard_join.one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "5", "7", "None"]
    assert jaccard_join.jaccard_components(empty).count() == 0


def test_signatures_lose_no_link():
    rng = np.random.default_rng(3)
    signatures = jaccard_join.Signatures(85)
    for _ in range(300):
        size = int(rng.integers(6, 400))
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        gone = int(rng.integers(0, size * 15 // 185 + 1))
        b = np.unique(np.concatenate([a[gone:], rng.integers(0, 1 << 63, gone, dtype=np.uint64)]))
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= 85 * (len(a) + len(b) - shared) and gone:
            assert np.intersect1d(signatures.of(a), signatures.of(b)).size


def test_histograms_rule_out_no_link():
    rng = np.random.default_rng(4)
    for size in (1, 7, 60, 900, 90_000):
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        for gone in (0, size * 15 // 185, size * 20 // 185, size // 2, size):
            b = np.unique(np.concatenate([a[gone:], rng.integers(0, 1 << 63, gone, dtype=np.uint64)]))
            shared = len(np.intersect1d(a, b))
            links = 100 * shared >= 85 * (len(a) + len(b) - shared)
            may = jaccard_join.may_link(
                jaccard_join.histogram(a), len(a), jaccard_join.histogram(b)[None], np.array([len(b)]), 85
            )[0]
            assert may or not links
            assert links or not may or gone < size // 2 or size > 10_000


def test_prefix_tree_finds_all_links():
    rng = np.random.default_rng(5)
    for _ in range(60):
        base = set(rng.integers(0, 60, 30).tolist())
        sets = [np.array(sorted((base | {int(rng.integers(0, 90))}) - {int(rng.integers(0, 60))}), np.uint64) for _ in range(8)]
        true = {(i, j) for i in range(8) for j in range(i)
                if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))}
        got = PrefixTree(sets).links(np.arange(8), np.ones(8, bool), 85)
        group = list(range(8))
        other = list(range(8))
        for links, labels in ((true, group), (got, other)):
            for _ in range(8):
                for a, b in links:
                    labels[a] = labels[b] = min(labels[a], labels[b])
        assert group == other


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (5, 5)], "a long, b long")
    found = {r.node: r.component for r in connected_components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert connected_components(edges.limit(0)).count() == 0


def test_base_statistics(documents, awkward):
    def base(t):
        w = re.findall(WORD, t or "")
        grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        count, cover = collections.Counter(grams), set()
        for i, g in enumerate(grams):
            if count[g] > 1:
                cover |= {i, i + 1, i + 2}
        lines = [x for x in (t or "").split("\n") if re.search(WORD, x)]
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(cover)

    for table in (documents, awkward):
        texts = {r.doc_id: r.text for r in table.collect()}
        rows = quality_rules.quality_rules(table).collect()
        assert len(rows) == table.count()
        for r in rows:
            want = base(texts[r.doc_id])
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
            assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
            assert not (r.base_failed and r.kept)


def test_quality_rules_reject_an_outlier_and_keep_the_rest(spark):
    rng = np.random.default_rng(1)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "lambda", "theta", "zeta"]
    rows = [(i, " ".join(rng.choice(words, 80) + rng.integers(0, 99, 80).astype(str)), "en", "s") for i in range(300)]
    rows.append((999, " ".join(f"w{i}&&&" for i in range(80)), "en", "s"))
    kept = {r.doc_id for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).filter("kept").collect()}
    assert kept == set(range(300))


def test_mixing_targets_and_limits(spark, awkward, empty):
    rows = [(i, "w " * (i % 7 + 1), ["a", "b", None, "c"][i % 4]) for i in range(400)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    total = collections.Counter()
    for r in found:
        assert r.taken <= 2 * r.size
        total[r.source, r.target, r.source_size] += r.taken
    assert all(taken == int(target) and target <= 2 * size for (_, target, size), taken in total.items())
    assert abs(sum(t for _, t, _ in total) - 1.5 * sum(s for _, _, s in total)) < 1e-6
    again = mixing.mix(spark.createDataFrame(rows[::-1], "doc_id long, text string, source string")).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    assert mixing.mix(awkward).count() == awkward.count() and mixing.mix(empty).count() == 0
    assert mixing.mixed_documents(awkward).columns == awkward.columns


def test_pii_surrogates(spark, awkward, empty):
    texts = [
        (1, "Mail of.55@mail9.example.com, call +1 (017) 555-7713 or +1 017-555-7713."),
        (2, "Mr. John Smith met Mary Smith. Card 4111-1111-1111-1111 or 4111 1111 1111 1111"),
        (3, 'token = "908038b7daaf91e8123a" at 97.51.17.173. SSN 123-45-6789'), (4, "x OF.55@MAIL9.example.com"),
        (5, "clean \x01 text \x02 here"), (6, None),
    ]
    out = {r.doc_id: r.text for r in pii.replace_pii(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert out[5] == texts[4][1] and out[6] is None
    mail = re.search(r"\S+@\S+(?=,)", out[1])[0]
    assert out[4] == f"x {mail}" and mail.endswith(".com") and "mail9" not in mail
    phones = re.findall(r"\+[\d ()-]+\d", out[1])
    assert phones[0].replace("(", "").replace(") ", "-") == phones[1] and "7713" not in out[1]
    first, second = re.search(r"Card (\S+) or (.+)", out[2]).groups()
    assert first.replace("-", " ") == second and first != "4111-1111-1111-1111"
    digits = [int(c) for c in second if c.isdigit()][::-1]
    assert sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0
    names = re.search(r"Mr\. (\S+) (\S+) met (\S+) (\S+)\.", out[2]).groups()
    assert names[1] == names[3] != "Smith" and names[2] in pii.GIVEN["given_f"] and names[2] != "Mary"
    assert re.search(r'token = "[0-9a-f]{20}" at [\d.]+\. SSN \d{3}-\d{2}-\d{4}', out[3]) and "97.51" not in out[3]
    assert pii.replace_pii(awkward).columns == awkward.columns and pii.replace_pii(awkward).count() == 9
    assert pii.replace_pii(empty).count() == 0


def test_pii_surrogates_stay_different(spark):
    ips = [("ip", f"10.0.{i // 250}.{i % 250 + 1}") for i in range(3000)]
    rows = pii.surrogates(spark.createDataFrame(ips, "kind string, norm string")).collect()
    assert len({r.surrogate for r in rows}) == 3000 and not {r.surrogate for r in rows} & {x for _, x in ips}


def test_pii_surrogates_of_a_full_shape(spark):
    """All addresses of a shape exist, and one of another shape: rounds end, all stay different."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    full = [("email", f"{x}@{y}.io") for x in letters for y in letters] + [("email", "someone@example.org"), ("ssn", "900-11-2222")]
    rows = pii.surrogates(spark.createDataFrame(full, "kind string, norm string")).collect()
    assert {(r.kind, r.norm) for r in rows} == set(full) and len({r.surrogate for r in rows}) == len(full)
    assert all(r.surrogate != r.norm for r in rows)
    assert all(re.fullmatch("[a-z]@[a-z].io", r.surrogate) for r in rows if r.norm.endswith(".io"))
    alone = pii._exchanged(spark.createDataFrame([("ip", "1.2.3.4"), ("ssn", "1"), ("ssn", "22")], "kind string, norm string"), "k")
    assert {(r.norm, r.surrogate) for r in alone.collect()} >= {("1", "22"), ("22", "1")}


def test_pii_names_with_initials_and_second_names(spark):
    texts = [(1, "We met John F. Kennedy there."), (2, "Mary Jane Watson called Peter Miller."), (3, "Kennedy and Watson are back."),
             (4, "Write to John F. Kennedy now.")]
    table = spark.createDataFrame(texts, "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii.replace_pii(table).collect()}
    assert "Kennedy" not in out[1] and re.fullmatch(r"We met \w+ [A-Z]\. \w+ there\.", out[1])
    assert not re.search("Mary|Jane|Watson|Peter|Miller", out[2])
    assert out[1].split()[2:5] == out[4].split()[2:5] and out[3] == texts[2][1]
    other = {r.doc_id: r.text for r in pii.replace_pii(table, key="another secret").collect()}
    assert other[2] != out[2]


def test_sentence_spans(spark, documents, awkward, empty):
    first, covered, pieces = {}, collections.defaultdict(set), {}
    for r in documents.orderBy("doc_id").collect():
        pieces[r.doc_id] = sentence_spans.sentences(r.text or "")
        assert "".join(pieces[r.doc_id]) == (r.text or "")
        for a, b, h in sentence_spans.runs(pieces[r.doc_id]):
            if h in first:
                covered[r.doc_id] |= set(range(a, b))
            first.setdefault(h, (r.doc_id, a))
    found = {r.doc_id: r.text for r in sentence_spans.deduplicated(documents).collect()}
    assert found == {i: "".join(p for k, p in enumerate(ps) if k not in covered[i]) for i, ps in pieces.items()}
    assert sentence_spans.deduplicated(awkward).count() == 9 and sentence_spans.deduplicated(empty).count() == 0
    passage = " ".join(f"word{i}" + ("." if i % 9 == 8 else "") for i in range(60))
    rows = spark.createDataFrame([(1, f"Own start.\n{passage}"), (2, f"Other.\n{passage}\nEnd here.")], "doc_id long, text string")
    out = {r.doc_id: r.text for r in sentence_spans.deduplicated(rows).collect()}
    assert out[1].endswith("word59") and "word30" not in out[2] and out[2].startswith("Other.") and out[2].endswith("End here.")


def test_sentence_spans_of_rows_that_share_an_id(spark):
    """A row loses what it repeats, never what another row of its id repeats."""
    passage = " ".join(f"Shared sentence number {i} has these words." for i in range(5))
    own = " ".join(f"Own sentence number {i} has other words." for i in range(5))
    rows = [(1, passage), (7, passage), (7, own), (7, own), (None, passage)]
    found = sentence_spans.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    assert collections.Counter((r.doc_id, r.text) for r in found.collect()) == {
        (1, passage): 1, (7, ""): 1, (7, own): 2, (None, passage): 1,
    }


def test_sentence_spans_of_spliced_passages(spark):
    """Passages of 51 to 60 words inside running text, at another offset in each document."""
    rng = np.random.default_rng(6)

    def prose(name, n, stop):
        return " ".join(f"{name}{rng.integers(1 << 40)}" + ("." if i % stop == stop - 1 else "") for i in range(n))

    texts, middles = {}, {}
    for n in range(51, 61):
        for stop in (8, 14, 22, 99):
            passage = prose("p", n, stop)
            middles[2 * len(middles) + 1] = passage.split()[10:-20]
            for before in (3, int(rng.integers(4, 40))):
                texts[len(texts)] = f"{prose('a', before, 99)} {passage} {prose('z', int(rng.integers(1, 30)), 99)}."
    found = {r.doc_id: r.text for r in sentence_spans.deduplicated(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    for i, middle in middles.items():
        assert found[i - 1] == texts[i - 1]
        assert not set(middle) & set(found[i].split())
        assert [w for w in texts[i].split() if w[0] != "p"] == [w for w in found[i].split() if w[0] != "p"]


def test_html_text(spark):
    footer = " ".join(f"shared{i}" for i in range(14))
    pages = [
        (1, "http://h/1", '<nav>Menu</nav><article><h1>T &amp; x</h1><p>One\n two<br>three<p><b>Four</b><div class="ad">Buy</div></article><footer>f</footer>'),
        (2, "http://h/2", f"<body><div>First alpha one</div><div>{footer}</div></body>"),
        (3, "http://h/3", f"<body><div>Second beta two</div><div>{footer}</div><script>var a='</p>';</script></body>"),
        (4, "http://other/4", f"<body><div>{footer}</div></body>"), (5, None, None), (6, "x", ""),
    ]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r.page_id: (r.text, r.n_chars) for r in html_text.extracted(table).collect()}
    assert found[1] == ("T & x\n\nOne two three\n\nFour", 26)
    assert [found[i][0] for i in (2, 3, 4, 5, 6)] == ["First alpha one", "Second beta two", footer, "", ""]
    assert html_text.extracted(table.limit(0)).count() == 0


def test_html_arrays_of_one_host_see_each_other(spark, monkeypatch):
    footer = " ".join(f"shared{i}" for i in range(14))
    pages = [(i, f"http://h/{i}", f"<body><div>own{i} text{i}</div><div>{footer}</div></body>") for i in range(6)]
    monkeypatch.setattr(html_text, "ARRAY_TOKENS", 20)
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_text.extracted(table).collect()} == {i: f"own{i} text{i}" for i in range(6)}


def test_html_spans_decide_on_marked_pages_too(spark):
    """Boilerplate inside the article goes, and a small article does not hide the page's text."""
    offer = " ".join(f"offer{i}" for i in range(12))
    pages = [(i, f"http://h/{i}", f"<article><p>{' '.join(f'own{i}x{j}' for j in range(30))}</p><p>{offer}</p></article>")
             for i in range(4)]
    pages.append((9, "http://g/9", f"<body><article>Teaser</article><div>{offer} and more</div></body>"))
    found = {r.page_id: r.text for r in html_text.extracted(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(found[i] == " ".join(f"own{i}x{j}" for j in range(30)) for i in range(4))
    assert found[9] == f"Teaser\n\n{offer} and more"


def test_html_copies_and_quotations_stay(spark, monkeypatch):
    """Pages without marked content: copies under other urls, near copies, a mirror without
    the footer, and a quotation inside paragraphs, on hosts of one array and of several."""
    def prose(name, n):
        return " ".join(f"{name}{j}" for j in range(n))

    def page(i, *texts):
        return (i, f"http://h/{i}?utm={i}", "<body>" + "".join(f"<div>{t}</div>" for t in texts) + "</body>")

    footer, quote = prose("shared", 14), prose("quote", 12)
    near = prose("near", 80)
    quoting = [f"{prose(f'before{i}x', 8)} {quote} {prose(f'after{i}x', 8)}" for i in range(2)]
    rows = [
        *(page(i, prose("copy", 60), footer) for i in range(5)), page(5, prose("copy", 60)),
        page(6, near), page(7, near.replace("near40", "edited")),
        *(page(8 + i, text, footer) for i, text in enumerate(quoting)), page(10, footer),
    ]
    want = {**{i: prose("copy", 60) for i in range(6)}, 6: near, 7: near.replace("near40", "edited"),
            8: quoting[0], 9: quoting[1], 10: footer}
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    for tokens in (500_000, 60):
        monkeypatch.setattr(html_text, "ARRAY_TOKENS", tokens)
        assert {r.page_id: r.text for r in html_text.extracted(table).collect()} == want


def test_posting_lists(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = {r.vec_id: np.array(r.embedding, float) for r in vectors.collect()}
    found = collections.defaultdict(list)
    for r in posting_lists.query(spark, SMALL).orderBy("query_id", "rank").collect():
        assert abs(r.score - rows[r.query_id] @ rows[r.vec_id]) < 1e-9
        found[r.query_id].append(r.vec_id)
    hits = 0
    for q in (i for i in rows if i % 20 == 0):
        best = sorted((-(rows[q] @ v), i) for i, v in rows.items() if i != q)[:20]
        hits += len({i for _, i in best} & set(found[q]))
    assert hits >= 0.9 * 20 * len(found) and all(len(x) == 20 for x in found.values())


def test_posting_lists_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(30)] + [(40, [0.0, 1.0]), (41, None), (42, [0.0, 0.0]), (43, [nan, 1.0]),
            (44, [inf, 1.0]), (45, [None, 1.0]), (46, [1.0]), (None, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = posting_lists.nearest(table, table.filter("vec_id in (0, 40)")).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in found if r.query_id == 0] == list(range(1, 21))
    assert [r.vec_id for r in found if r.query_id == 40] == list(range(20))
    assert posting_lists.nearest(table.limit(0), table).count() == 0


def test_posting_lists_clean_queries_of_their_own(spark):
    rng = np.random.default_rng(3)
    table = spark.createDataFrame([(i, [float(c) for c in v], "x") for i, v in enumerate(rng.normal(size=(60, 4)))], "vec_id long, embedding array<double>, score string")
    asks = spark.createDataFrame(
        [(1, None), (2, []), (3, [0.0] * 4), (4, [1.0] * 3), (5, [float("nan")] * 4), (None, [1.0] * 4), (7, [1.0, 0.0, 0.0, 0.0])],
        "vec_id long, embedding array<double>")
    found = posting_lists.nearest(table, asks, 5).collect()
    assert {r.query_id for r in found} == {7} and [r.rank for r in sorted(found, key=lambda r: r.rank)] == [1, 2, 3, 4, 5]


def test_best_neighbours_are_kept_once():
    best = posting_lists._Best(2)
    best.add(np.array([1, 1, 2]), np.array([5, 6, 5]), np.array([0.5, 0.9, 0.1]))
    best.add(np.array([1, 1, 1]), np.array([6, 7, 4]), np.array([0.9, 0.2, 0.5]))
    best.cut()
    assert [b.to_pydict() for b in best.out()] == [{"q": [1, 1, 2], "first": [6, 4, 5], "score": [0.9, 0.5, 0.1]}]
    assert best.out() == []


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(2)
    y = rng.random(20_000) < 0.3
    true = [0.9, 0.8, 0.7, 0.85]
    votes = np.stack([np.where(rng.random(len(y)) < a, y, ~y) * 2 - 1 for a in true], 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = label_model.fit(patterns, counts.astype(float), 1 / (1 + np.exp(-patterns.sum(1).astype(float))))
    assert np.abs(model.accuracies - true).max() < 0.05 and abs(model.prior - 0.3) < 0.05


def test_toxicity_and_quality(spark, documents, awkward, empty):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = toxicity.toxicity(docs, labels).filter("held_out").join(labels, "doc_id").select("score", "toxic", "predicted").collect()
    pos, neg = [r.score for r in held if r.toxic], [r.score for r in held if not r.toxic]
    assert np.mean([np.mean(p > np.array(neg)) for p in pos]) > 0.9
    assert np.mean([r.predicted for r in held if r.toxic]) > 0.8
    assert np.mean([r.predicted for r in held if not r.toxic]) < 0.03
    small = toxicity.toxicity(awkward, labels.limit(0)).collect()
    assert len(small) == 9 and all(0 <= r.score <= 1 for r in small)
    good = quality_classifier.quality(docs).join(labels, "doc_id").select("score", "quality").collect()
    pos, neg = [r.score for r in good if r.quality], [r.score for r in good if not r.quality]
    assert np.mean([np.mean(p > np.array(neg)) for p in pos]) > 0.95
    assert quality_classifier.quality(awkward).count() == 9 and quality_classifier.quality(empty).count() == 0
