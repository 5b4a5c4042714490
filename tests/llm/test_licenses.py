import pytest

from perennial.llm import license_texts, licenses


def test_headers_and_nearest_directory(spark):
    rows = [
        ("a/LICENSE", "Some words.\nReleased under the MIT License."),
        ("a/b/c/LICENSE.txt", "Licensed under the Apache License, Version 2.0."),
        ("a/b/x.py", "no header"),
        ("a/b/c/d/y.py", "nothing"),
        ("a/b/c/z.py", "  all rights reserved  "),
        ("other/file", "Licensing is a word"),
        ("top", None),
        ("top", None),
        (None, ""),
    ]
    out = licenses.scan(spark.createDataFrame([(*r, 1) for r in rows], "path string, text string, license int"))
    got = sorted(((r["path"], r["header_license"], r["inherited_license"], r["inherited_from"], r["license"]) for r in out.collect()), key=repr)
    assert got == sorted(
        [
            ("a/LICENSE", "MIT", "MIT", "a", "MIT"),
            ("a/b/c/LICENSE.txt", "Apache-2.0", "Apache-2.0", "a/b/c", "Apache-2.0"),
            ("a/b/x.py", None, "MIT", "a", "MIT"),
            ("a/b/c/d/y.py", None, "Apache-2.0", "a/b/c", "Apache-2.0"),
            ("a/b/c/z.py", "proprietary", "Apache-2.0", "a/b/c", "proprietary"),
            ("other/file", None, None, None, None),
            ("top", None, None, None, None),
            ("top", None, None, None, None),
            ("", None, None, None, None),
        ],
        key=repr,
    )


def test_key_words_miss_no_match():
    import itertools
    import math

    rows, other, keys = licenses.template_words(licenses.TEMPLATES)
    for number in range(len(licenses.TEMPLATES)):
        left = math.sqrt(sum(w * w for word, _, n, _, w in rows if n == number and word not in keys))
        assert left < licenses.THRESHOLD
    assert all(w > 0 for *_, w in rows) and other > 1 and len(list(itertools.chain(keys))) == len(set(keys))


def test_license_at_the_top_and_ties(spark):
    rows = [("LICENSE-1", "Licensed under CC BY 4.0."), ("LICENSE-2", "All rights reserved."), ("d/f", "x")]
    out = {r["path"]: r for r in licenses.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    # both match fully: the first by name stands
    assert out["d/f"]["license"] == "CC-BY-4.0" and out["d/f"]["inherited_from"] == ""


def test_empty_table_long_text_and_threshold(spark):
    none = spark.createDataFrame([], "path string, text string")
    assert licenses.scan(none).count() == 0
    long = spark.createDataFrame([("p", "word line\n" * 50_000 + "Released under the MIT License.")], "path string, text string")
    assert licenses.scan(long).first()["license"] == "MIT"
    with pytest.raises(ValueError):
        licenses.detect(none, threshold=0.5)


def _wrapped(text, mark, width=12):
    words = text.split()
    return "\n".join(mark + " ".join(words[i : i + width]) for i in range(0, len(words), width))


def test_header_blocks_and_whole_licence_files(spark):
    texts = {name: text for name, text in license_texts.TEXTS if len(text) > 450}
    prose = "Some words of the text that stand around it, for more than one line of any file."
    rows = [
        ("Copyright 2020 Foo Inc. All rights reserved.", "proprietary"),
        ("// Copyright (c) 2019 Jane Doe. Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
        ("# SPDX-License-Identifier: MIT", "MIT"),
        ("# SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0"),
        ("SPDX-License-Identifier: Foo-9", None),
        ("MIT License", "MIT"),
        ("GNU GENERAL PUBLIC LICENSE", "GPL"),
        ("GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991", "GPL-2.0"),
        ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", "LGPL-3.0"),
        ("mit mit", None),
        (prose + " It is Released under the MIT License. " + prose, "MIT"),
        ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
        ("/* This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU Affero General Public\n"
         " * License as published by the Free Software Foundation, either version 3\n * of the License, or (at your option) any later version. */", "AGPL-3.0"),
        (prose, None),
    ]
    for name in ("MIT", "MIT-0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "ISC", "0BSD", "Zlib"):
        whole = f"Copyright (c) 2019, Jane Doe\n{_wrapped(texts[name], ' * ')}"
        rows += [(whole, name), (prose + "\n" + whole + "\n" + prose * 20, name)]
    # the notice of rights comes before the grant
    rows.append((f"Copyright 2020 Foo Inc. All rights reserved.\n{_wrapped(texts['Apache-2.0'], '# ')}\n{prose}".replace("at http", "from http"), "Apache-2.0"))
    files = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(rows)], "path int, text string")
    got = {r["id"]: r["license"] for r in licenses.detect(files).collect()}
    assert [(text, got.get(i)) for i, (text, _) in enumerate(rows)] == rows


def test_windows_score_as_their_vectors():
    import math
    import random
    from collections import Counter

    rng = random.Random(3)
    templates = [("A", "a b c d a b"), ("B", "c d e f g"), ("C", "a a a b c d e f g h")]
    book = licenses.Book(templates, 0.8)
    for n in (3, 8, 60):
        words = [rng.choice("abcdefghxy") for _ in range(n)]
        got = {(t, s): score for t, s, _, score in book.windows(words, range(len(templates)))}
        wanted = {}
        for t, size in enumerate(book.lengths):
            for start in range(max(1, n - size + 1)):
                x = {w: k * book.idf.get(w, book.other) for w, k in Counter(words[start : start + size]).items()}
                dot = sum(v * book.weights[book.place[w], t] for w, v in x.items() if w in book.place)
                wanted[t, start] = round(dot / math.sqrt(sum(v * v for v in x.values())), 6)
        assert all(abs(wanted[key] - score) < 2e-6 for key, score in got.items())
        assert {t for t, _ in got} == {t for (t, _), score in wanted.items() if score >= 0.8}
