"""Hand-made observations with known profiles."""

from __future__ import annotations

from dossierlake.dictionary import AttrDictionary

DICTIONARY = AttrDictionary(single=["B010001", "B010011"], multi=["B010007"])
LAYOUT = [
    "A010001", "A010002", "H010014", "B050016", "H010001", "H010003",
    "B010001", "B010011", "B010007",
]


def _five(oid, source, month, second, last_alias="a"):
    rows = [
        ("01 12:05:20", "Ada", "a"),
        ("02 12:25:21", second, "b"),
        ("02 12:05:22", second, "a,b"),
        ("11 12:05:23", second, "b,c"),
        ("05 12:05:24", "Ada", last_alias),
    ]
    return [
        ("one.example", oid, f"2014-{month}-{at}", source, "p1", "x", name, "1", alias)
        for at, name, alias in rows
    ]


FIRST = (
    _five("u1", "116", "10", "Bob") + _five("u2", "116", "11", "Bob")
    + _five("u1", "120", "12", "Cyd", "a2")
)
SECOND = [
    ("one.example", "u1", "2013-10-11 12:05:23", "116", "p1", "x", "Bob", "1", "b,c"),
    ("two.example", "u3", "2013-10-11 12:05:23", "116", "p1", "x", "Dan", "1", "d,e"),
]


def write_file(path, rows):
    lines = ["@" + "\t".join(LAYOUT), "# comment", ""] + ["\t".join(r) for r in rows]
    with open(path, "w", encoding="utf-8") as handle:
        handle.write("\n".join(lines) + "\n")
    return str(path)


def group_rows(oid, source, second, month, last=("a", 3)):
    """Expected (oid, source, code, value, cnt, first, last, days) of five observations."""
    d1, d2, d5, d11 = (f"2014{month}{d}" for d in ("01", "02", "05", "11"))

    def at(day, time):
        return f"2014-{month}-{day} 12:05:{time}"

    rows = {
        ("B010001", "Ada", 2, at("01", 20), at("05", 24), f"{d1}:1,{d5}:1"),
        ("B010001", second, 3, at("02", 22), at("11", 23), f"{d2}:2,{d11}:1"),
        ("B010007", "b", 3, at("02", 22), at("11", 23), f"{d2}:2,{d11}:1"),
        ("B010007", "c", 1, at("11", 23), at("11", 23), f"{d11}:1"),
        ("B010011", "1", 5, at("01", 20), at("11", 23), f"{d1}:1,{d2}:2,{d5}:1,{d11}:1"),
    }
    if last[0] == "a":
        rows.add(("B010007", "a", 3, at("01", 20), at("05", 24), f"{d1}:1,{d2}:1,{d5}:1"))
    else:
        rows.add(("B010007", "a", 2, at("01", 20), at("02", 22), f"{d1}:1,{d2}:1"))
        rows.add(("B010007", last[0], 1, at("05", 24), at("05", 24), f"{d5}:1"))
    return {(oid, source, *r) for r in rows}
