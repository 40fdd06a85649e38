"""Licence scan by template-markup matching.

A template is a licence notice in markup: ``<<opt>> ... <<end>>`` holds
wording that may be absent, ``<<var LO HI>>`` stands for LO to HI words of
any kind, everything else is mandatory wording. All templates are compiled
into one deterministic token automaton (subset construction over the words
that occur in templates plus one class for every other word); a place of a
text is accepted when the words from there on lead to an accepting state,
so its mandatory wording matches exactly, word for word.

The automaton is built once on the driver, is as large as the templates
and is sent to the tasks; the texts are scanned where they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tickwise.llm.common import map_texts

OTHER = b""          # the class of every word that no template has
MAX_STATES = 50_000  # of the automaton; more means a template is too loose

# The base phrases and their labels.
BASE_PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]

_HOLDER = "<<opt>>copyright <<var 1 16>><<end>>"
_MIT = ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction")
_MIT_RIGHTS = (_MIT + " including without limitation the rights to use copy modify merge publish distribute "
               "sublicense and or sell copies of the software and to permit persons to whom the software is "
               "furnished to do so")
_MIT_DISCLAIMER = (
    "the software is provided as is without warranty of any kind express or implied including but not limited to "
    "the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall "
    "<<var 1 12>> be liable for any claim damages or other liability whether in an action of contract tort or "
    "otherwise arising from out of or in connection with the software or the use or other dealings in the software")
_ISC = ("permission to use copy modify and <<opt>>or<<end>> distribute this software for any purpose with or without "
        "fee is hereby granted")
_ISC_DISCLAIMER = (
    "the software is provided as is and <<var 1 12>> disclaims all warranties with regard to this software including "
    "all implied warranties of merchantability and fitness in no event shall <<var 1 12>> be liable for any special "
    "direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits "
    "whether in an action of contract negligence or other tortious action arising out of or in connection with the "
    "use or performance of this software")
_BSD = ("redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met")
_BSD_CONDITIONS = (
    _BSD + " <<opt>>1<<end>> redistributions of source code must retain the above copyright notice this list of "
    "conditions and the following disclaimer <<opt>>2<<end>> redistributions in binary form must reproduce the above "
    "copyright notice this list of conditions and the following disclaimer in the documentation and or other "
    "materials provided with the distribution")
_BSD_NAMES = ("<<opt>>3<<end>> neither the name of <<var 1 12>> nor the names of its contributors may be used to "
              "endorse or promote products derived from this software without specific prior written permission")
_BSD_DISCLAIMER = (
    "this software is provided by <<var 1 12>> as is and any express or implied warranties including but not limited "
    "to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event "
    "shall <<var 1 12>> be liable for any direct indirect incidental special exemplary or consequential damages "
    "including but not limited to procurement of substitute goods or services loss of use data or profits or business "
    "interruption however caused and on any theory of liability whether in contract strict liability or tort "
    "including negligence or otherwise arising in any way out of the use of this software even if advised of the "
    "possibility of such damage")
_UNLICENSE = "this is free and unencumbered software released into the public domain"

# Full licences, all their mandatory wording.
_FULL = [
    ("mit", f"{_HOLDER} {_MIT_RIGHTS} subject to the following conditions the above copyright notice and this "
            "permission notice <<opt>>including the next paragraph<<end>> shall be included in all copies or "
            f"substantial portions of the software {_MIT_DISCLAIMER}"),
    ("mit-0", f"{_HOLDER} {_MIT_RIGHTS} {_MIT_DISCLAIMER}"),
    ("isc", f"{_HOLDER} {_ISC} provided that the above copyright notice and this permission notice appear in all "
            f"copies {_ISC_DISCLAIMER}"),
    ("0bsd", f"{_HOLDER} {_ISC} {_ISC_DISCLAIMER}"),
    ("bsd-2-clause", f"{_HOLDER} {_BSD_CONDITIONS} {_BSD_DISCLAIMER}"),
    ("bsd-3-clause", f"{_HOLDER} {_BSD_CONDITIONS} {_BSD_NAMES} {_BSD_DISCLAIMER}"),
    ("unlicense", f"{_UNLICENSE} anyone is free to copy modify publish use compile sell or distribute this software "
                  "either in source code form or as a compiled binary for any purpose commercial or non commercial "
                  "and by any means in jurisdictions that recognize copyright laws the author or authors of this "
                  "software dedicate any and all copyright interest in the software to the public domain we make "
                  "this dedication for the benefit of the public at large and to the detriment of our heirs and "
                  "successors we intend this dedication to be an overt act of relinquishment in perpetuity of all "
                  f"present and future rights to this software under copyright law {_MIT_DISCLAIMER}"),
]

_LGPL, _AGPL, _CC0 = "gnu lesser general public license", "gnu affero general public license", "cc0 1 0"

# The openings that full licences share with others, and bare names: hints,
# like the base phrases. ``scan`` accepts no licence by them.
HINTS = [("mit", _MIT), ("isc", _ISC), ("bsd", _BSD), ("unlicense", _UNLICENSE),
         ("lgpl", _LGPL), ("agpl", _AGPL), ("cc0-1.0", f"<<opt>>creative commons<<end>> {_CC0} universal")]

# Words that deny the notice they stand before ("isn't" is two words).
DENIALS = frozenset(w.encode() for w in ("not", "never", "cannot", "nor", "longer", "t"))

# How a text says that a licence applies to it.
_STATED = [f"{verb} under" for verb in ("licensed", "released", "distributed", "available")]
_NAMED = [(label, markup)
          for label, name in (("lgpl", _LGPL), ("agpl", _AGPL))
          for markup in [*(f"{s} the <<opt>>terms of the<<end>> {name}" for s in _STATED),
                         f"under the terms of the {name}",
                         f"{name} as published by the free software foundation"]]
_NAMED += [("cc0-1.0", f"{s} <<opt>>the<<end>> <<opt>>creative commons<<end>> {_CC0} <<opt>>universal<<end>>")
           for s in _STATED]

# Wording of public licence notices.
TEMPLATES = [
    ("cc-by-4.0", "<<opt>>licensed under<<end>> <<opt>>a<<end>> <<opt>>the<<end>> cc by 4 0 <<opt>>international<<end>> <<opt>>license<<end>>"),
    ("cc-by-sa-4.0", "<<opt>>licensed under<<end>> <<opt>>a<<end>> <<opt>>the<<end>> cc by sa 4 0 <<opt>>international<<end>> <<opt>>license<<end>>"),
    ("cc-by-nd-4.0", "<<opt>>licensed under<<end>> <<opt>>a<<end>> <<opt>>the<<end>> cc by nd 4 0 <<opt>>international<<end>> <<opt>>license<<end>>"),
    ("cc-by-nc-4.0", "<<opt>>licensed under<<end>> <<opt>>a<<end>> <<opt>>the<<end>> cc by nc 4 0 <<opt>>international<<end>> <<opt>>license<<end>>"),
    ("cc-by-nc-sa-4.0", "<<opt>>licensed under<<end>> <<opt>>a<<end>> <<opt>>the<<end>> cc by nc sa 4 0 <<opt>>international<<end>> <<opt>>license<<end>>"),
    ("cc-by-nc-nd-4.0", "<<opt>>licensed under<<end>> <<opt>>a<<end>> <<opt>>the<<end>> cc by nc nd 4 0 <<opt>>international<<end>> <<opt>>license<<end>>"),
    ("cc-by-4.0", "creative commons attribution 4 0 international <<opt>>public<<end>> license"),
    ("cc-by-sa-4.0", "creative commons attribution sharealike 4 0 international <<opt>>public<<end>> license"),
    ("cc-by-nc-4.0", "creative commons attribution noncommercial 4 0 international <<opt>>public<<end>> license"),
    ("apache-2.0", "licensed under the apache license version 2 0 <<opt>>the license<<end>> <<opt>>you may not use this file except in compliance with the license<<end>>"),
    ("apache-2.0", "spdx license identifier apache 2 0"),
    ("mit", "spdx license identifier mit"),
    ("mit", "<<opt>>this <<var 1 4>> is<<end>> released under the mit license"),
    ("mit", "licensed under the <<opt>>terms of the<<end>> mit license"),
    *HINTS,
    *_FULL,
    *_NAMED,
    ("gpl-2.0", "<<opt>>this <<var 1 4>> is<<end>> licensed under the <<opt>>terms of the<<end>> gnu general public license version 2"),
    ("gpl-3.0", "<<opt>>this <<var 1 4>> is<<end>> licensed under the <<opt>>terms of the<<end>> gnu general public license version 3"),
    ("gpl-2.0-or-later", "gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-3.0-or-later", "gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
]

# Lower-cases A-Z and turns every byte that no word holds into a space.
_WORD_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
                    else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


@dataclass(frozen=True)
class Automaton:
    """``step[state]`` maps a word to the next state; ``other[state]`` is the
    next state for every word not in it (-1: none); ``accepts[state]`` lists
    the templates accepted there; ``starts`` are the words that can begin one."""
    step: list[dict[bytes, int]]
    other: list[int]
    accepts: list[tuple[int, ...]]
    starts: frozenset[bytes]


def parse(markup: str) -> list:
    """Markup as a tree: words, ('var', lo, hi) and ('opt', [...])."""
    out: list = []
    stack = [out]
    for piece in markup.replace("<<", "\0<<").replace(">>", ">>\0").split("\0"):
        if piece == "<<opt>>":
            inner: list = []
            stack[-1].append(("opt", inner))
            stack.append(inner)
        elif piece == "<<end>>":
            stack.pop()
        elif piece.startswith("<<var"):
            lo, hi = map(int, piece[5:-2].split())
            stack[-1].append(("var", lo, hi))
        elif piece.startswith("<<"):
            raise ValueError(f"unknown markup {piece!r}")
        else:
            stack[-1].extend(words_of(piece.encode()))
    if len(stack) != 1:
        raise ValueError(f"<<opt>> and <<end>> don't match in {markup!r}")
    return out


def compile_templates(templates: list[str]) -> Automaton:
    """One deterministic automaton for all templates."""
    arcs: list[list[tuple[bytes | None, int]]] = []   # None: any word
    skips: list[list[int]] = []                        # arcs without a word

    def state() -> int:
        arcs.append([])
        skips.append([])
        return len(arcs) - 1

    def build(tree: list, at: int) -> int:
        for x in tree:
            if isinstance(x, bytes):
                arcs[at].append((x, nxt := state()))
                at = nxt
            elif x[0] == "var":
                ends = [at] if x[1] == 0 else []
                for k in range(1, x[2] + 1):
                    arcs[at].append((None, nxt := state()))
                    at = nxt
                    if k >= x[1]:
                        ends.append(at)
                end = state()
                for e in ends:
                    skips[e].append(end)
                at = end
            else:
                end = build(x[1], at)
                join = state()
                skips[at].append(join)
                skips[end].append(join)
                at = join
        return at

    root = state()
    final: dict[int, int] = {}
    for i, markup in enumerate(templates):
        begin = state()
        skips[root].append(begin)
        final[build(parse(markup), begin)] = i

    def closed(states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in skips[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    first = closed([root])
    number, queue = {first: 0}, [first]
    step, other, accepts = [], [], []

    def numbered(states) -> int:
        if not states:
            return -1
        s = closed(states)
        if s not in number:
            number[s] = len(number)
            queue.append(s)
            if len(number) > MAX_STATES:
                raise ValueError("the templates need too many states")
        return number[s]

    while len(step) < len(queue):
        now = queue[len(step)]
        free = {t for s in now for w, t in arcs[s] if w is None}
        named = {w for s in now for w, _ in arcs[s] if w is not None}
        step.append({w: numbered(free | {t for s in now for x, t in arcs[s] if x == w}) for w in named})
        other.append(numbered(free))
        accepts.append(tuple(sorted(final[s] for s in now if s in final)))
    if other[0] != -1 or accepts[0]:
        raise ValueError("a template must begin with a mandatory or optional word")
    return Automaton(step, other, accepts, frozenset(step[0]))


def matches(auto: Automaton, words: list[bytes]) -> list[tuple[int, int, int]]:
    """(template, first word, end) of every accepted place, longest end per
    template and first word."""
    out = []
    step, other, accepts, starts = auto.step, auto.other, auto.accepts, auto.starts
    n = len(words)
    for i in [i for i, w in enumerate(words) if w in starts]:
        at, j, ends = 0, i, {}
        while j < n:
            at = step[at].get(words[j], other[at])
            j += 1
            if at < 0:
                break
            for t in accepts[at]:
                ends[t] = j
        out.extend((t, i, e) for t, e in ends.items())
    return out


def accepted(words: list[bytes], places: list[tuple[int, int, int]], names: list[str], n_base: int,
             hints: set[int]) -> list:
    """The places that count: base phrases wherever they stand, and notices
    that are no hints and that no word of DENIALS stands before. A shorter
    match of the same label at the end of a denied one is denied with it."""
    denied = {(names[t], e) for t, i, e in places if t >= n_base and i and words[i - 1] in DENIALS}
    return [m for m in places if m[0] < n_base or m[0] not in hints and (names[m[0]], m[2]) not in denied]


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
         templates: list[tuple[str, str]] | None = None, hints: list[tuple[str, str]] | None = None) -> DataFrame:
    """Columns ``keep``, then n_words, n_base, first_word, last_word,
    base_labels, labels, score and spans (label, first_word, end_word) of
    every accepted place, in order.

    Full licences are accepted by all their mandatory wording; their openings,
    bare names of licences and notices with a denial before them ("not licensed
    under ...") give neither label nor span. ``templates`` and ``hints`` replace
    TEMPLATES and HINTS; a caller's template is never a hint.

    A null or empty text has no words, no places, empty label strings, null
    first_word and last_word and score 0. score is 1 if a notice template is
    accepted, 0.5 if only base phrases, hints or denied notices occur, else 0.
    Repeated rows are scanned each; further columns are ignored unless named in
    ``keep``.
    """
    keep = ["doc_id"] if keep is None else keep
    if templates is None:
        stated, hinted = [x for x in TEMPLATES if x not in HINTS], HINTS if hints is None else hints
    else:
        stated, hinted = templates, hints or []
    notices = [*stated, *hinted]
    names = [n for n, _ in BASE_PHRASES] + [n for n, _ in notices]
    n_base = len(BASE_PHRASES)
    hint_ids = set(range(n_base + len(stated), n_base + len(notices)))
    auto = compile_templates([m for _, m in BASE_PHRASES] + [m for _, m in notices])

    def make():
        def run(texts):
            out = [[] for _ in range(8)]
            for t in texts:
                words = words_of(t)
                places = matches(auto, words)
                found = accepted(words, places, names, n_base, hint_ids)
                base = [(x, i) for x, i, _ in found if x < n_base]
                at = [i for _, i in base]
                own = any(x >= n_base for x, _, _ in found)
                row = (len(words), len(base), min(at, default=None), max(at, default=None),
                       ",".join(sorted({names[x] for x, _ in base})),
                       ",".join(sorted({names[x] for x, _, _ in found})),
                       1.0 if own else 0.5 if places else 0.0,
                       [{"label": names[x], "first_word": i, "end_word": e}
                        for x, i, e in sorted(found, key=lambda m: (m[1], m[2], m[0]))])
                for c, v in zip(out, row):
                    c.append(v)
            return out
        return run

    fields = [("n_words", "bigint"), ("n_base", "bigint"), ("first_word", "bigint"),
              ("last_word", "bigint"), ("base_labels", "string"), ("labels", "string"),
              ("score", "double"),
              ("spans", "array<struct<label:string,first_word:bigint,end_word:bigint>>")]
    return map_texts(docs, text, keep, fields, make, binary=True)
