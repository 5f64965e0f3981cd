import time

import pytest

from tallyline.llm import licenses

HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License "
    "as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
)
LINE = "This work is licensed under the GNU {}General Public License, version {}."
BSD = next(t for t in licenses.TEMPLATES["BSD-3-Clause"] if t.startswith("Redis"))
BSD2 = next(t for t in licenses.TEMPLATES["BSD-2-Clause"] if t.startswith("Redis"))


@pytest.mark.parametrize(
    ("text", "names"),
    [
        *[(form.format(kind, v), [n]) for form in (HEADER, LINE) for kind, v, n in (("", 2, "GPL-2.0"), ("", 3, "GPL-3.0"), ("Lesser ", "2.1", "LGPL-2.1"), ("Lesser ", 3, "LGPL-3.0"), ("Affero ", 3, "AGPL-3.0"))],
        (HEADER.format("Library ", 2), []),
        *[(f"Licensed under CC BY{k} {v}.", [f"CC-BY{k}-{v}"]) for k in ("", "-SA", "-NC", "-ND", "-NC-SA", "-NC-ND") for v in ("4.0", "3.0")],
        ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", ["CC-BY-NC-ND-4.0"]),
        ("Licensed under CC BY 2.0.", []),
        ("Released under the BSD License.", []),
        ("Licensed under the BSD 2-Clause License.", ["BSD-2-Clause"]),
        ("Licensed under the Apache License, Version 1.1.", []),
        (BSD, ["BSD-3-Clause"]),
        (BSD + BSD2[BSD2.index(" THIS") :], ["BSD-3-Clause"]),
        (BSD.replace("copyright holder", "author").replace("Neither", "x Neither"), ["BSD-3-Clause"]),
        (BSD2, ["BSD-2-Clause"]),
        ("GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", ["LGPL-3.0"]),
        ("Apache License Version 2.0, January 2004 http://www.apache.org/licenses/", ["Apache-2.0"]),
        ("Mozilla Public License Version 2.0 1. Definitions", ["MPL-2.0"]),
    ],
)
def test_near_relatives(text, names):
    assert [n for _, _, n, _ in licenses.found(f"before it. {text} And behind.")] == names


def test_many_votes_in_one_text():
    """Work grows with the votes of a text, not with their square; every copy far from the others is found."""
    began = time.process_time()
    licenses.found("released mit license under " * 50_000)
    assert time.process_time() - began < 100  # some twelve minutes when every vote looked at all others
    line = "Licensed under the Apache License, Version 2.0. " + "word " * 60
    got = licenses.found(line * 500)
    assert [x[2] for x in got] == ["Apache-2.0"] * 500
    assert [x[0] for x in got] == [got[0][0] + k * len(line) for k in range(500)]
