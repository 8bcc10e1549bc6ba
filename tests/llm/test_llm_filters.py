"""Decontamination, toxicity, licenses, personal data and URL rules on small planted cases."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa

import oracle
from pressgauge.llm import decontaminate, licenses, pii, toxicity, url_filter

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, texts):
    return spark.createDataFrame([(k, t, "en", "s", None if t is None else len(t)) for k, t in texts], DOCS)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(n))


# -- 1 ---------------------------------------------------------------------------------------------------------


def infix_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination_against_edit_distance(spark):
    rng = random.Random(5)
    items = [(k, prose(rng, n)) for k, n in enumerate((20, 12, 60, 30))] + [(8, "too short"), (9, None), (None, prose(rng, 30))]
    plain = {k: t for k, t in items if k is not None and t and len(t) >= decontaminate.MIN_CHARS}

    def damaged(text, edits):
        text = list(text)
        for at in rng.sample(range(len(text)), edits):
            text[at] = rng.choice(["", "zz", "q"])
        return "".join(text)

    texts = [(0, None), (1, ""), (2, prose(rng, 300)), (3, "too short")]
    for k, t in plain.items():
        texts += [(10 + k, prose(rng, 50) + " " + t + " " + prose(rng, 20)), (20 + k, t.upper().replace(" ", ",\n ")), (30 + k, t)]
        texts += [(100 + 20 * k + e, prose(rng, 30) + " " + damaged(t[:100], e) + " " + prose(rng, 30)) for e in range(0, 20)]
        texts += [(300 + k, prose(rng, 9) + " " + t[:30] + " " + prose(rng, 9)), (310 + k, prose(rng, 9000) + " " + t)]
    frame = docs(spark, texts)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.find(frame, bench, **decontaminate.LARGE).collect()}

    def norm(text):
        return re.sub(r"[^a-z0-9]+", " ", (text or "").lower()).strip()

    expected = set()
    for d, text in texts:
        for k, t in plain.items():
            t = norm(t)
            last = max(len(t) - 100, 0)
            windows = [t[s:s + 100] for s in [*range(0, last, 50), last]]
            if d < 310 and any(infix_distance(w, norm(text)) <= len(w) // 10 for w in windows):
                expected.add((d, k))
    assert {x for x in got if x[0] < 310} == expected
    assert {(310 + k, k) for k in plain} <= set(got) and len(expected) > 30
    for (d, k), r in got.items():
        text = dict(texts)[d]
        assert 0 <= r["start"] < r["end"] <= len(text)
        if r["edits"] == 0 and d < 40:
            assert norm(text[r["start"]:r["end"]]) in norm(plain[k])
    kept = {r["doc_id"] for r in decontaminate.remove(frame, bench, **decontaminate.LARGE).collect()}
    assert kept == {d for d, _ in texts} - {d for d, _ in got}
    assert decontaminate.remove(frame, bench, **decontaminate.LARGE).columns == frame.columns
    assert decontaminate.find(frame, bench.limit(0)).count() == 0
    assert decontaminate.find(frame.limit(0), bench).count() == 0


def test_decontamination_of_passages_at_every_offset(spark):
    """Excerpts of an item, exact and edited, against brute force over all of the item's runs, not over its windows."""
    rng = random.Random(11)
    item = prose(rng, 80)[:300].strip()
    size, passage, rest = decontaminate.SMALL, decontaminate.PASSAGE, [prose(rng, 40) for _ in range(7)]
    texts, must = [], set()
    for n, edits in ((passage, 0), (80, 0), (80, 3), (passage, 4), (90, 12), (20, 0), (size - 6, 0)):
        for at in range(0, len(item) - n + 1):
            own = list(item[at:at + n])
            for k in rng.sample(range(1, n - 1), edits):
                # A blank or its neighbour that is gone would take another blank along.
                own[k] = rng.choice(["q", own[k] + "q", "q" if " " in item[at + k - 1:at + k + 2] else ""])
            d = len(texts)
            texts.append((d, f"{rest[d % 7]} {''.join(own)} {rest[(d + 3) % 7]}"))
            if edits <= size // 10 and len(item[at:at + n].strip()) >= passage:
                must.add(d)

    def norm(text):
        return re.sub(r"[^a-z0-9]+", " ", text.lower()).strip()

    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    got = {r["doc_id"]: r for r in decontaminate.find(docs(spark, texts), bench).collect()}
    assert must <= set(got) and len(must) > 700
    for d, text in texts[::100]:
        near = min(infix_distance(item[s:s + size], norm(text)) for s in range(len(item) - size + 1))
        assert d not in got or near <= size // 10, (d, near)
    # Neighbouring windows are one place.
    d = next(d for d in sorted(must) if d > 246)
    assert got[d]["end"] - got[d]["start"] >= 72 and got[d]["edits"] == 0


def test_decontamination_by_short_items(spark):
    rng = random.Random(12)

    def text(n):
        own = "q" + prose(rng, n)[:n - 2] + "q"
        return own if "  " not in own else text(n)

    items = {n: text(n) for n in (3, 7, 8, 12, 15, 16, 20, 23, 24, 30, 31, 32, 39, 40, 47)}
    most = {n: min(n // 10, n // 8 - 1) if n > 15 else 0 for n in items}
    texts, expected = [(0, "q"), (1, None), (2, "")], set()
    for n, item in items.items():
        for edits in range(6):
            own = list(item)
            for at in rng.sample(range(1, n - 1), min(edits, n - 2)):
                own[at] = "9"
            for rest in (prose(rng, 30), ""):
                d = len(texts)
                texts.append((d, f"{rest}, {''.join(own).upper()}! {rest}"))
                expected |= {(d, n)} if edits <= most[n] else set()
        if n < 16:
            texts += [(len(texts) + k, t) for k, t in enumerate((f"a{item} b", f"a {item}b", item[:-1], f"{item[:-1]}"))]
        # The next document goes on where this one ends.
        texts += [(len(texts) + k, t) for k, t in enumerate((item[:n // 2], item[n // 2:]))]
    rows = [*items.items(), (100, items[7]), (100, items[7]), (101, "?!"), (102, None)]
    bench = spark.createDataFrame(rows, "item_id bigint, text string")
    frame = docs(spark, texts).coalesce(1)
    found = decontaminate.find(frame, bench).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert got == expected | {(d, 100) for d, n in expected if n == 7} and len(got) == len(found)
    for r in found:
        if r["edits"] == 0:
            item = items[7 if r["item_id"] == 100 else r["item_id"]]
            own = dict(texts)[r["doc_id"]][r["start"]:r["end"]].lower()
            assert re.sub(r"[^a-z0-9]+", " ", own) == item
    kept = {r["doc_id"] for r in decontaminate.remove(frame, bench).collect()}
    assert kept == {d for d, _ in texts} - {d for d, _ in got}
    only = spark.createDataFrame([(7, items[7])], "item_id bigint, text string")
    assert {r["doc_id"] for r in decontaminate.find(frame, only).collect()} == {d for d, n in expected if n == 7}


def test_decontamination_in_parts(spark, monkeypatch):
    rng = random.Random(6)
    items = [(k, prose(rng, 30)) for k in range(12)]
    frame = docs(spark, [(k, prose(rng, 5) + " " + t) for k, t in items])
    monkeypatch.setattr(decontaminate, "PART_BYTES", 500)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert len(decontaminate.passages(bench)) > 2
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find(frame, bench).collect()} == {(k, k) for k in range(12)}
    assert decontaminate.remove(frame, bench).count() == 0


def _frequencies(rng, n):
    """Prose of invented words as frequent as words are."""
    words = [prose(random.Random(k), 1) for k in range(3000)]
    weight = [1 / (k + 2.7) for k in range(len(words))]
    return " ".join(rng.choices(words, weight, k=n))


def _hits(items, texts, windows=decontaminate.WINDOWS):
    index = decontaminate.Index(items, windows=windows)
    return sorted(
        (piece.first + d, *sorted(hit.items()))
        for piece in decontaminate.pieces(pa.array(texts)) for d, hit in decontaminate._found(index, piece)
    )


def test_decontamination_frequent_grams(monkeypatch):
    """Leaving frequent q-grams out of the count, and searching in short runs, changes nothing."""
    rng = random.Random(13)
    items = [(k, _frequencies(rng, 60)) for k in range(120)] + [(200, "0 " * 150), (201, "0 " * 150), (202, _frequencies(rng, 9))]
    texts = [_frequencies(rng, 400) for _ in range(20)]
    for k in range(0, 120, 5):
        own = list(items[k][1])
        for at in rng.sample(range(len(own)), k // 6):
            own[at] = rng.choice(["q", "", "zz"])
        texts.append(_frequencies(rng, 50) + " " + "".join(own) + " " + _frequencies(rng, 50))
    texts += ["0 " * 900, "x " + "0 " * 30]
    now = _hits(items, texts)
    assert {h[0] for h in now} >= {20, 21, 22, len(texts) - 2, len(texts) - 1}
    monkeypatch.setattr(decontaminate, "PAIRS", 500)
    assert _hits(items, texts) == now
    monkeypatch.setattr(decontaminate, "FREQUENT", 1 << 40)
    assert _hits(items, texts) == now
    monkeypatch.undo()
    monkeypatch.setattr(decontaminate, "SHARED", 1)
    monkeypatch.setattr(decontaminate, "FREQUENT", 1)
    assert _hits(items, texts) == now


def test_decontamination_memory():
    """Memory follows neither the benchmark times the text nor repetition."""
    import tracemalloc

    rng = random.Random(14)
    own = _frequencies(rng, 20_000)
    many = [(k, own[s:s + 400]) for k, s in enumerate(range(0, len(own), 400))]
    for items, text in ((many, _frequencies(rng, 20_000)), ([(1, "0 " * 150)], "0 " * 8000), ([(1, "0 1 2 " * 3000)], "0 1 2 " * 5000)):
        index = decontaminate.Index(items)
        tracemalloc.start()
        for piece in decontaminate.pieces(pa.array([text])):
            for _ in decontaminate._found(index, piece):
                pass
        assert tracemalloc.get_traced_memory()[1] < 200e6
        tracemalloc.stop()


# -- 2 ---------------------------------------------------------------------------------------------------------


def test_toxicity_held_out(spark):
    rng = random.Random(7)
    bad = ["grumwort", "snarkle", "vexlump"]
    texts, labels = [], []
    for k in range(600):
        words = prose(rng, rng.randrange(5, 120)).split()
        toxic = k % 5 == 0
        if toxic:
            for _ in range(rng.randrange(1, 9)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(bad).title())
        texts.append((k, " ".join(words)))
        if k < 300:
            labels.append((k, 1, int(toxic)))
    texts += [(700, None), (701, ""), (0, texts[0][1])]
    labels += [(0, 1, 1), (None, 1, 1), (3, 0, None), (9999, 1, 1)]
    frame = docs(spark, texts)
    lab = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    rows = toxicity.score(frame, lab).collect()
    assert len(rows) == len(texts)
    got = {r["doc_id"]: r for r in rows}
    wrong = [k for k in range(300, 600) if got[k]["toxic"] != (k % 5 == 0)]
    assert len(wrong) <= 3
    assert not got[700]["toxic"] and got[700]["severity"] == got[701]["severity"]
    assert all(0 <= r["severity"] <= toxicity.GRADES for r in rows)
    dense, thin = docs(spark, [(1, "grumwort snarkle vexlump " * 4)]), docs(spark, [(1, "grumwort " + prose(rng, 100))])
    model = toxicity.trained(frame, lab)
    high, low = (model.chances(model.values(pa.array([r["text"] for r in f.collect()]))).sum() for f in (dense, thin))
    assert high > low
    kept = {r["doc_id"] for r in toxicity.clean(frame, lab).collect()}
    assert kept == {k for k, r in got.items() if not r["toxic"]}
    assert toxicity.clean(frame, lab.limit(0)).count() == len(texts)
    assert toxicity.score(frame.limit(0), lab).count() == 0


def test_ordered_cuts_share_weights():
    rng = np.random.default_rng(1)
    rows = []
    for k in range(400):
        toxic = k % 2
        n = rng.integers(1, 6) if toxic else 0
        rows.append((np.array([3, 8]) if n else np.array([3]), np.array([10, n]) if n else np.array([10]), toxic))
    model = toxicity.fit(rows)
    assert (np.diff(model.cuts) > 0).all()
    p = model.chances(np.array([0.0, 2.0, 9.0]))
    assert (np.diff(p, axis=1) <= 0).all() and (np.diff(p, axis=0) >= 0).all()


# -- 4 ---------------------------------------------------------------------------------------------------------


def test_licenses(spark):
    rng = random.Random(8)
    notices = {
        "Apache-2.0": "Licensed under the Apache License, Version 2.0", "MIT": "Released under the MIT License",
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    }
    apache, gpl, mit = notices["Apache-2.0"], notices["GPL-3.0"], notices["MIT"]
    long = prose(rng, 30000)
    texts = [
        (0, None), (1, ""), (2, prose(rng, 100)), (3, apache), (4, prose(rng, 33) + ".\n" + gpl.upper() + ".\n" + prose(rng, 7)),
        (5, f"{long} {mit} {long} ü {mit}."), (6, gpl.replace("work", "thing")), (7, "This work is licensed"), (8, f"{apache}. {gpl}"),
    ]
    got = sorted((r["doc_id"], r["license"], r["start"], r["end"], r["containment"]) for r in licenses.scan(docs(spark, texts)).collect())
    text = dict(texts)
    assert [(d, name) for d, name, *_ in got] == [
        (3, "Apache-2.0"), (4, "GPL-3.0"), (5, "MIT"), (5, "MIT"), (6, "GPL-3.0"), (8, "Apache-2.0"), (8, "GPL-3.0"),
    ]
    for d, name, a, b, share in got:
        # The changed word of document 6 touches two of ten shingles; its end is a notice of its own.
        assert text[d][a:b].lower() == (notices[name] if d != 6 else notices[name].replace("work", "thing")).lower()[a if d == 6 else 0:]
        assert share >= 0.8 and (d == 6 or share == 1.0)
    # Another version is no find.
    changed = docs(spark, [(1, gpl.replace("version 3", "version 9"))])
    assert licenses.scan(changed).count() == 0
    assert licenses.scan(docs(spark, texts), templates={}).count() == 0


def test_license_bodies_and_notices(spark):
    rng = random.Random(10)
    program = (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    )
    isc = (
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies."
    )
    said = [
        ("Licensed under the MIT License", "MIT"), ("// SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0"),
        ("This software is licensed under the GNU General Public License, version 3", "GPL-3.0"), (isc, "ISC"),
        ("GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007", "GPL-3.0"), (program, "GPL-3.0"),
        (program.replace("GNU General", "GNU Affero General"), "AGPL-3.0"), (program.replace("version 3", "version 2"), "GPL-2.0"),
        ("under the GNU General Public License, version 9", None), (program.replace("version 3", "version 9"), None),
        ("licensed under the GNU Affero General Public License, version 3", "AGPL-3.0"), ("# SPDX-License-Identifier: MIT", "MIT"),
        ("Permission to use the MIT library was granted under the general terms of version 3", None),
    ]
    texts = [(k, f"{prose(rng, 40)}. {text} {prose(rng, 30)}") for k, (text, _) in enumerate(said)]
    got = {(r["doc_id"], r["license"]) for r in licenses.scan(docs(spark, texts)).collect()}
    assert got == {(k, name) for k, (_, name) in enumerate(said) if name}
    # Whole bodies, some words of each changed, in longer texts: one find each, under its own name.
    bodies = {name: max(several, key=len) for name, several in licenses.TEMPLATES.items() if len(max(several, key=len)) > 500}
    assert len(bodies) > 15 and {"MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1"} <= set(bodies)
    texts, plain = [], {name: " ".join(body.replace("{", "").replace("}", "").split()) for name, body in sorted(bodies.items())}
    for name, body in plain.items():
        words = body.split()
        for at in rng.sample(range(len(words) // 4, len(words) // 2), len(words) // 100):
            words[at] = "zzz"
        texts += [(name, f"{prose(rng, 50)} {body} {prose(rng, 50)}"), (name + "~", f"{prose(rng, 700)} {' '.join(words)}")]
    rows = licenses.scan(spark.createDataFrame(texts, "doc_id string, text string")).collect()
    assert sorted((r["doc_id"], r["license"]) for r in rows) == sorted((d, d.rstrip("~")) for d, _ in texts)
    whole = {r["doc_id"]: r["containment"] for r in rows}
    assert all(whole[name] == 1.0 and 0.8 <= whole[name + "~"] <= 1.0 for name in bodies)


def test_license_windows_against_brute_force(spark):
    rng = random.Random(9)
    template = prose(rng, 25)
    words = template.split()
    texts = []
    for k in range(60):
        own = list(words)
        for at in rng.sample(range(len(own)), k % 4):
            own[at] = "zzz"
        texts.append((k, " ".join([prose(rng, k), *own, prose(rng, 40)])))

    def runs(ws):
        return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)}

    expected = {d for d, t in texts if len(runs(words) & runs(t.split())) / len(runs(words)) >= 0.8}
    got = {r["doc_id"] for r in licenses.scan(docs(spark, texts), templates={"own": template}).collect()}
    assert got == expected and 5 < len(expected) < 60


# -- 5 ---------------------------------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            good = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 16 <= len(digits) <= 19 and pii.luhn(digits), "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(10)
    parts = ["a@b.co", "@", ".", "-", "+", " ", "1", "22", "255", "256", "4111111111111111", "4111 1111 1111 1111", "x", "ü", "(", ")", "%", "1.2.3.4", "+1 (366) 555-9807"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))
        assert pii.base_spans(text) == plain_spans(text), text
    for text in ("1" * 50000, "a" * 50000 + "@", "@" * 50000, "+" * 50000, "1." * 30000, "a@" * 30000):
        pii.spans(text)


def test_octets_of_any_length():
    """Python's int() takes 4300 digits at most."""
    for octet, good in (("0" * 5000, True), ("0" * 5000 + "255", True), ("0" * 5000 + "256", False), ("1" * 5000, False)):
        text = f"see {octet}.1.1.1"
        assert [s for s in pii.base_spans(text) if s[0] == "ip"] == ([("ip", 4, len(text))] if good else [])


def test_added_spans_and_scores():
    def kinds(text):
        return [s[0] for s in pii.spans(text)]

    assert kinds("IBAN DE89 3704 0044 0532 0130 00 BITTE") == ["iban"]
    assert kinds("GB82 WEST 1234 5698 7654 32 The") == ["iban"]
    assert kinds("DE89 3704 0044 0532 0130 01") == []
    assert kinds("amex card 378282246310005") == ["short_card"]
    assert kinds("number 378282246310005") == []
    assert kinds("ssn 078-05-1120") == ["id_number"] and kinds("078-05-1120") == []
    assert pii.spans("mail me@site.org")[0][3] > pii.spans("example me@site.org")[0][3]


def test_pii_report_and_redaction(spark):
    text = "ü write to x.y@mail.example.com or +1 (366) 555-9807 from 10.0.0.1"
    frame = docs(spark, [(1, text), (2, None), (3, ""), (1, text)])
    rows = pii.report(frame).collect()
    assert len(rows) == 4
    r = next(r for r in rows if r["doc_id"] == 1)
    base = ",".join(f"{k}:{a}:{b}" for k, a, b in plain_spans(text))
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 1, 0, 1)
    assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and r["spans"].startswith(base)
    out = pii.stage(spark, frame, "")
    assert out.columns == frame.columns and out.schema == frame.schema
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert got[1][0] == "ü write to <EMAIL> or <PHONE> from <IP>" and got[1][1] == len(got[1][0])
    assert got[2] == (None, None) and got[3] == ("", 0)


# -- 6 ---------------------------------------------------------------------------------------------------------

PAGES = "page_id bigint, url string, html string"


def test_url_rules_and_aliases(spark, tmp_path, monkeypatch):
    def link(to):
        return f'<html><head><LINK rel="canonical" href="{to}"></head></html>'

    rows = [
        (1, "https://A.Example.COM/de/x?q#f", ""), (2, "http://example.net/en/", None), (3, "http://example.net/fr", ""),
        (4, "http://a.org/fr/", link("http://other.info/1")), (5, "http://other.info/1#top", link("http://example.com/de/9")),
        (6, "http://third.info/a", link("//x.net/")), (7, "http://third.info/b/c", '<meta http-equiv=refresh content="0; url=../a">'),
        (8, "http://third.info/b", link("/a")), (9, None, ""), (10, "no scheme", link("http://x.net/")), (11, "http://net", ""),
        (12, "http://notexample.com/de/", ""), (13, "http://m.info/1", link("http://example.com/de/1")),
        (14, "http://example.com/de/1?x", link("http://m.info/2")), (15, "ftp://M.info/2", ""), (8, "http://third.info/b", link("/a")),
        (None, "http://x.net/q", ""), (16, "http://m.info/1#again", ""),
    ]
    frame = spark.createDataFrame(rows, PAGES)
    out = url_filter.judge(frame)
    assert out.count() == len(rows)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()}
    assert got[1] == ("a.example.com", "/de/x", "example.com/de/", "block")
    assert got[2][2:] == ("example.net/en/", "allow") and got[3][2:] == ("net/", "block")
    assert got[4][2:] == ("org/fr/", "allow")
    assert got[5][2:] == (None, "allow")  # an allowed alias goes before a blocked one
    assert got[6][2:] == (None, "block") and got[8][2:] == (None, "block")
    assert got[9] == ("", "", None, "allow") and got[10] == ("", "", None, "allow")
    assert got[11] == ("net", "", None, "allow") and got[12][2:] == (None, "allow")
    assert got[13][2:] == (None, "block") and got[16][2:] == (None, "block") and got[14][2:] == ("example.com/de/", "block")
    assert got[None][2:] == ("net/", "block")
    redirects = spark.createDataFrame([("http://third.info/b/c", "http://third.info/a")], "source string, target string")
    more = {r["page_id"]: r["verdict"] for r in url_filter.judge(frame, redirects=redirects).collect()}
    assert more[7] == "block"
    assert url_filter.judge(frame.limit(0)).count() == 0
    # The same pages through SQL.
    frame.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert oracle.compare(out, con, url_filter.SQL) is None
