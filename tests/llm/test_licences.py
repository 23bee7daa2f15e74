"""Licence scan against a plain restatement."""

import re
from collections import Counter

import pytest

from tickloom.llm import licences

from .cases import documents, odd_texts, story


def plain(text, templates, least=0.8):
    def pairs(t):
        w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower())
        return Counter(zip(w, w[1:]))

    best = {}
    text = text or ""
    units = [("line", u) for u in text.split("\n")] + [("block", u) for u in re.split(r"\n[ \t\r\x0b\x0c]*(?=\n)", text)] + [("text", text)]
    for rank, (scope, unit) in enumerate(units):
        a = pairs(unit)
        found = None
        for name in sorted(templates):
            for t in sorted(templates[name]):
                b = pairs(t)
                size = sum(a.values()) + sum(b.values())
                dice = 2 * sum((a & b).values()) / size if size else 0
                if dice >= least and (found is None or dice > found[0]):
                    found = dice, name
        if found and found[0] > best.get(found[1], (0, ""))[0]:
            best[found[1]] = found[0], scope
    return best


def test_scan_equals_plain(spark):
    t = licences.TEMPLATES
    rows = odd_texts()
    rows += [
        (50, f"{story(1, 30)}\nReleased under the MIT License."),
        (51, "licensed under cc by-nc 4.0!!"),
        (52, "Licensed under CC BY 4.0\nLicensed under CC BY-NC 4.0"),
        (53, t["MIT"][2]),
        (54, f"{story(2, 40)}\n \n{t['Apache-2.0'][2]}\n\n{story(3, 40)}"),
        (55, t["GPL-3.0"][2].replace("\n", " ").replace("published", "issued") + "\n" + story(4, 9)),
        (56, "This work is licensed under the GNU General Public License, version 3."),
        (57, "The License is under discussion. Released yesterday under rain."),
        (58, "\n\n\n \nISC\n"),
        (59, "a\r\nReleased under the ISC License.\r\n"),
        (60, f"{story(5, 400)} Released under the MIT License. {story(6, 400)}"),
    ]
    got = licences.licences(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    want = Counter()
    for i, text in rows:
        best = plain(text, t)
        top = max(((d, s, n) for n, (d, s) in best.items()), key=lambda x: (x[0], [-ord(c) for c in x[2]]), default=(None, None, None))
        want[i, top[2], top[1], top[0], tuple(sorted(best))] += 1
    assert Counter((r.doc_id, r.licence, r.scope, r.dice, tuple(r.found)) for r in got) == want
    by_id = {r.doc_id: r.licence for r in got}
    assert [by_id[i] for i in range(50, 61)] == ["MIT", "CC-BY-NC-4.0", "CC-BY-4.0", "MIT", "Apache-2.0", "GPL-3.0", "GPL-3.0", None, None, "ISC", None]


def test_size_bounds_drop_nothing():
    """Near copies of every template, at and around the threshold."""
    known = licences.Templates(licences.TEMPLATES)
    import pyarrow as pa

    for name, texts in licences.TEMPLATES.items():
        for text in texts:
            w = re.findall(r"[^\s]+", text)
            for drop in range(0, len(w), max(1, len(w) // 7)):
                near = " ".join(w[:drop] + ["changed"] + w[drop + 1 :])
                got = {n: pytest.approx(d) for _, n, _, d in licences.scan(known, pa.array([near], pa.string()), 0.8)}
                want = plain(near, licences.TEMPLATES)
                assert got == {n: d for n, (d, _) in want.items()}, (name, near)


def test_empty(spark):
    assert licences.licences(documents(spark, [])).count() == 0
    assert licences.licences(documents(spark), templates={}).where("licence is not null").count() == 0


def test_notices_anywhere(spark):
    """Texts of several paragraphs among others, notices inside lines and wrapped ones; runs against brute force."""
    t = licences.TEMPLATES
    mit = t["MIT"][2].replace(" The above copyright", "\n\nThe above copyright").replace(" THE SOFTWARE IS", "\n\nTHE SOFTWARE IS")
    apache = t["Apache-2.0"][2].replace(" http:", "\n\n    http:").replace("2.0 Unless", "2.0\n\nUnless")
    assert mit.count("\n\n") == apache.count("\n\n") == 2
    rows = [
        (1, f"{story(1, 300)}\n\n{mit}\n\n{story(2, 300)}"),
        (2, f"{story(3, 300)}\n\n{apache}\n\n{story(4, 300)}"),
        (3, f"{story(5, 400)} Released under the MIT License. {story(6, 400)}"),
        (4, f"{story(7, 90)}\nMore words here. Released under the\nISC License. {story(8, 9)}\n{story(9, 90)}"),
        (5, f"{story(7, 90)} {' '.join(mit.split())} {story(9, 90)} licensed under CC BY-SA 4.0 {story(2, 9)}"),
        (6, "The License is under discussion. Released yesterday under rain."),
        (7, "licensed under CC"),
        (8, "BY 4.0"),
        (9, None),
    ]
    got = {r.doc_id: r for r in licences.licences(documents(spark, rows), anywhere=True).collect()}
    assert [got[i].licence for i in range(1, 10)] == ["MIT", "Apache-2.0", "MIT", "ISC", "CC-BY-SA-4.0", None, None, None, None]
    assert got[5].found == ["CC-BY-SA-4.0", "MIT"] and got[3].scope == "window" and got[3].dice == 1
    one = {"X": ("a b a b c d e",)}
    import pyarrow as pa

    want = Counter(zip("ababcd", "babcde"))
    for seed in range(200):
        w = [chr(97 + (seed * 7919 + k * k * 31 + k * (seed % 13)) % 6) for k in range(12)]
        w[3:8] = "ababc" if seed % 3 == 0 else w[3:8]
        runs = [Counter(zip(w[i:j], w[i + 1 : j])) for i in range(12) for j in range(i + 2, 13)]
        best = max(2 * sum((r & want).values()) / (sum(r.values()) + 6) for r in runs)
        found = licences.scan(licences.Templates(one), pa.array([" ".join(w)]), 0.6, anywhere=True)
        assert (found[0][3] if found else 0) == pytest.approx(best if best >= 0.6 else 0), w
