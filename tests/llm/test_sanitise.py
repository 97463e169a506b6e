from __future__ import annotations

from landfold.llm import sanitise


def texts():
    """One name stands beside one address only, in ever new company; another is everywhere."""
    near = [f"{w} lighthouse {v} write to keeper@sea.example.org today" for w, v in zip("abcdefgh", "ijklmnop", strict=True)]
    far = [f"{w} harbour {v} is open" for w, v in zip("abcdefgh", "qrstuvwx", strict=True)]
    return near + far


def test_terms_that_reveal_a_value(documents):
    terms = {r["term"]: r["kind"] for r in sanitise.revealing_terms(documents(texts())).collect()}
    assert terms["lighthouse"] == "removed"
    assert not {"harbour", "open", "is"} & set(terms)


def test_copies_make_no_terms(documents):
    copies = ["the odd lighthouse of old has keeper@sea.example.org within"] * 50 + [f"line {i}" for i in range(50)]
    assert sanitise.revealing_terms(documents(copies)).collect() == []


def test_sanitised_text(documents):
    docs = documents([*texts(), "A Lighthouse far away", None, "", "call +1 555 010 9999 or 10.0.0.1"])
    out = [r["text"] for r in sanitise.sanitise(docs).orderBy("doc_id").collect()]
    # Every "write" stands beside the address, and eight "lighthouse" of nine.
    assert out[0] == "a [GENERALISED] i  to [EMAIL] today"
    assert "keeper@" not in "".join(t or "" for t in out)
    assert out[8] == "a harbour q is open"
    assert out[16:] == ["A [GENERALISED] far away", None, "", "call [PHONE] or [IP]"]


def test_base_spans_stay_and_rows_stay(documents):
    docs = documents([*texts(), *texts()], [*range(16), *[None] * 16]).selectExpr("*", "1 AS personal_spans", "2 AS _key")
    rows = sanitise.find_personal(docs).collect()
    assert len(rows) == 32 and {r["_key"] for r in rows} == {2}
    for r in rows:
        kinds = [s["kind"] for s in r["personal_spans"]]
        assert kinds[:1] == (["email"] if "@" in r["text"] else [])
        assert kinds == sorted(kinds, key=sanitise.KINDS.index)


def test_empty_table(documents):
    assert sanitise.find_personal(documents([])).collect() == []


def test_spans_replace_a_column_of_their_name(documents):
    for texts_ in (texts(), ["nothing here"]):
        docs = documents(texts_).selectExpr("*", "1 AS personal_spans")
        assert sanitise.find_personal(docs).columns.count("personal_spans") == 1


def planted():
    """A surname beside one address in two lines; the others have a word in its place."""
    lines = ["mr ganderby lives here ganderby@post.example.com", "ask mr ganderby works there ganderby@post.example.com"]
    lines += [f"{w} mr neighbour {v} nowhere" for w in "abc" for v in ("lives", "works", "sleeps")]
    return [*lines, *(f"mr {w} sings" for w in ("adams", "bell", "clark"))]


def test_a_name_beside_an_address_in_two_lines(documents):
    terms = {r["term"]: (r["kind"], r["broader"]) for r in sanitise.revealing_terms(documents(planted())).collect()}
    assert terms == {"ganderby": ("generalised", "neighbour")} or "ganderby" not in terms
    # The address holds the name; with an address of other letters the name is the term.
    docs = documents([t.replace("ganderby@", "g77@") for t in planted()])
    terms = {r["term"]: (r["kind"], r["broader"]) for r in sanitise.revealing_terms(docs).collect()}
    assert terms == {"ganderby": ("generalised", "neighbour")}
    out = [r["text"] for r in sanitise.sanitise(docs).orderBy("doc_id").collect()]
    assert out[0] == "mr neighbour lives here [EMAIL]" and out[2:] == planted()[2:]


def brute_disclosure(texts_):
    """PMI of all pairs by counting in plain Python."""
    import math
    import re
    from collections import defaultdict

    lines = [line for t in texts_ for line in (t or "").split("\n")]
    all_contexts, near, c_e = defaultdict(set), defaultdict(set), defaultdict(int)
    for line in lines:
        values = set(re.findall(r"[a-z0-9]+@[a-z0-9]+(?:\.[a-z]+)+", line.lower()))
        words = re.findall(r"[^\W\d_]+", line.lower())
        own = {w for v in values for w in re.findall(r"[^\W\d_]+", v)} | ({"email"} if values else set())
        for e in values:
            c_e[e] += 1
        for i, w in enumerate(words):
            context = (words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else "")
            all_contexts[w].add(context)
            for e in values:
                if w not in own:
                    near[e, w].add(context)
    out = {}
    for (e, w), contexts in near.items():
        if len(contexts) >= 2:
            p_e = c_e[e] / len(lines)
            p = (len(contexts) + 0.5 * p_e) / (len(all_contexts[w]) + 0.5)
            out["email:" + e, w] = (len(contexts), len(all_contexts[w]), math.log2(p / p_e), -math.log2(p))
    return out


def test_information_against_brute_force(documents):
    import random

    r = random.Random(12)
    words = "river stone Bridge cloud ember frost grove Hollow iris juniper kestrel lantern".split()
    values = ["a1@x.org", "b2@y.net", "c3@z.com"]
    line = lambda: " ".join(
        r.choice(words) for _ in range(r.randint(1, 8))
    ) + (" " + r.choice(values) if r.random() < 0.3 else "") + r.choice(["", " " + r.choice(words)])
    corpus = ["\n".join(line() for _ in range(r.randint(1, 6))) for _ in range(120)]
    corpus += [corpus[0]] * 20 + [None, "", "kestrel " * 3000]
    got = {(x["e"], x["term"]): (x["c_te"], x["c_t"], x["pmi"], x["open"]) for x in sanitise.disclosure(documents(corpus)).collect()}
    want = brute_disclosure(corpus)
    assert got.keys() == want.keys() and len(want) > 10
    for k, (c_te, c_t, pmi, left) in want.items():
        assert got[k][:2] == (c_te, c_t)
        assert abs(got[k][2] - pmi) < 1e-9 and abs(got[k][3] - left) < 1e-9
