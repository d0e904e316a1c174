"""The ordered signature rules of the license scan, on words joined by single spaces.

A rule has a label, a keyword, a priority, a confidence, and the pattern. Names are
written out by hand; four sentence forms around each name and the texts of well-known
notices make the rest. The words that a text must hold before a pattern is tried are
derived from the pattern; the keyword is only the one preferred where matches hold it.
"""

from collections import Counter
from functools import lru_cache
from re import _parser
from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    keyword: str
    priority: int
    confidence: float
    pattern: str


# label, keyword, the name as a pattern, the SPDX identifiers as words
NAMES = (
    ("mit", "mit", r"(?:expat )?mit(?: style| type)?", r"mit"),
    ("mit-0", "mit", r"mit no attribution", r"mit 0"),
    ("x11", "x11", r"(?:x11|mit x11|x consortium)", r"x11"),
    ("apache", "apache", r"apache(?: software)?", r"apache 2 0"),
    ("apache-1.1", "apache", r"apache(?: software)? license(?: version)? 1 1", r"apache 1 1"),
    ("apache-2.0", "apache", r"(?:apache(?: software)? license(?: version)? 2(?: 0)?|asl 2 0)", r"apache 2 0"),
    ("gpl", "gpl", r"(?:gnu )?gpl", r"gpl"),
    ("gpl", "general", r"(?:gnu )?general public", r"gpl"),
    ("gpl-1.0", "gpl", r"(?:gnu )?gpl ?(?:version |v)?1(?: 0)?", r"gpl 1 0(?: only| or later)?"),
    ("gpl-2.0", "gpl", r"(?:gnu )?gpl ?(?:version |v)?2(?: 0)?", r"gpl 2 0(?: only| or later)?"),
    ("gpl-2.0", "general", r"gnu general public license(?: as published by the free software foundation)?(?: either)? version 2(?: 0)?", r"gpl 2 0"),
    ("gpl-3.0", "gpl", r"(?:gnu )?(?:gpl ?(?:version |v)?3(?: 0)?|gplv3)", r"gpl 3 0(?: only| or later)?"),
    ("gpl-3.0", "general", r"gnu general public license(?: as published by the free software foundation)?(?: either)? version 3(?: 0)?", r"gpl 3 0"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl", r"lgpl"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public", r"lgpl"),
    ("lgpl", "library", r"(?:gnu )?library general public", r"lgpl"),
    ("lgpl-2.1", "lgpl", r"(?:gnu )?lgpl ?(?:version |v)?2 1", r"lgpl 2 1(?: only| or later)?"),
    ("lgpl-2.1", "lesser", r"gnu lesser general public license version 2 1", r"lgpl 2 1"),
    ("lgpl-3.0", "lgpl", r"(?:gnu )?lgpl ?(?:version |v)?3(?: 0)?", r"lgpl 3 0(?: only| or later)?"),
    ("lgpl-3.0", "lesser", r"gnu lesser general public license version 3(?: 0)?", r"lgpl 3 0"),
    ("agpl", "agpl", r"(?:gnu )?agpl", r"agpl"),
    ("agpl", "affero", r"(?:gnu )?affero general public", r"agpl"),
    ("agpl-3.0", "agpl", r"(?:gnu )?agpl ?(?:version |v)?3(?: 0)?", r"agpl 3 0(?: only| or later)?"),
    ("agpl-3.0", "affero", r"gnu affero general public license version 3(?: 0)?", r"agpl 3 0"),
    ("gfdl", "documentation", r"gnu free documentation", r"gfdl 1 [123](?: only| or later)?"),
    ("bsd", "bsd", r"(?:modified |revised |simplified |original )?bsd(?: style| type)?", r"bsd"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|two clause bsd|freebsd)", r"bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd)", r"bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|four clause bsd)", r"bsd 4 clause"),
    ("0bsd", "0bsd", r"(?:0bsd|zero clause bsd)", r"0bsd"),
    ("isc", "isc", r"isc", r"isc"),
    ("mpl", "mozilla", r"mozilla public", r"mpl"),
    ("mpl-1.1", "mozilla", r"mozilla public license(?: version)? 1 1", r"mpl 1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public license(?: version| v)? 2(?: 0)?", r"mpl 2 0"),
    ("mpl-2.0", "mpl", r"mpl ?(?:version |v)?2(?: 0)?", r"mpl 2 0"),
    ("epl", "eclipse", r"eclipse public", r"epl"),
    ("epl-1.0", "eclipse", r"eclipse public license(?: version| v)? 1 0", r"epl 1 0"),
    ("epl-2.0", "eclipse", r"eclipse public license(?: version| v)? 2 0", r"epl 2 0"),
    ("edl-1.0", "eclipse", r"eclipse distribution", r"edl 1 0"),
    ("cddl", "cddl", r"(?:common development and distribution|cddl)", r"cddl 1 [01]"),
    ("cpl-1.0", "common", r"common public", r"cpl 1 0"),
    ("cpal-1.0", "attribution", r"common public attribution", r"cpal 1 0"),
    ("eupl", "european", r"european union public", r"eupl 1 [012]"),
    ("cecill", "cecill", r"cecill", r"cecill 2 [01]"),
    ("osl-3.0", "open", r"open software", r"osl 3 0"),
    ("afl-3.0", "academic", r"academic free", r"afl 3 0"),
    ("artistic", "artistic", r"(?:perl )?artistic", r"artistic 1 0"),
    ("artistic-2.0", "artistic", r"artistic license(?: version)? 2(?: 0)?", r"artistic 2 0"),
    ("bsl-1.0", "boost", r"boost(?: software)?", r"bsl 1 0"),
    ("busl-1.1", "business", r"business source", r"busl 1 1"),
    ("sspl-1.0", "server", r"server side public", r"sspl 1 0"),
    ("elastic-2.0", "elastic", r"elastic", r"elastic 2 0"),
    ("cc0-1.0", "cc0", r"(?:creative commons )?cc0(?: 1 0)?(?: universal)?", r"cc0 1 0"),
    ("cc-by", "attribution", r"creative commons attribution(?: [1234] 0)?(?: international| unported| generic)?", r"cc by [1234] 0"),
    ("cc-by-sa", "sharealike", r"creative commons attribution sharealike(?: [1234] 0)?(?: international| unported| generic)?", r"cc by sa [1234] 0"),
    ("cc-by-nc", "noncommercial", r"creative commons attribution noncommercial(?: [1234] 0)?(?: international| unported| generic)?", r"cc by nc [1234] 0"),
    ("cc-by-nc-sa", "sharealike", r"creative commons attribution noncommercial sharealike(?: [1234] 0)?(?: international| unported| generic)?", r"cc by nc sa [1234] 0"),
    ("cc-by-nd", "noderivatives", r"creative commons attribution noderivatives(?: [1234] 0)?(?: international| unported| generic)?", r"cc by nd [1234] 0"),
    ("unlicense", "unlicense", r"unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"(?:wtfpl|do what the fuck you want to public)", r"wtfpl"),
    ("zlib", "zlib", r"zlib(?: libpng)?", r"zlib"),
    ("libpng", "libpng", r"libpng", r"libpng 2 0"),
    ("openssl", "openssl", r"openssl", r"openssl"),
    ("psf-2.0", "python", r"python(?: software foundation)?", r"(?:psf|python) 2 0"),
    ("php-3.01", "php", r"php", r"php 3 01"),
    ("ruby", "ruby", r"ruby", r"ruby"),
    ("postgresql", "postgresql", r"postgresql", r"postgresql"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?", r"ncsa"),
    ("upl-1.0", "universal", r"universal permissive", r"upl 1 0"),
    ("ms-pl", "microsoft", r"microsoft public", r"ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal", r"ms rl"),
    ("ofl-1.1", "font", r"(?:sil )?open font", r"ofl 1 1"),
    ("lppl", "latex", r"latex project public", r"lppl 1 3[abc]?"),
    ("odbl-1.0", "database", r"open(?: data commons open)? database", r"odbl 1 0"),
    ("odc-by-1.0", "commons", r"open data commons attribution", r"odc by 1 0"),
    ("mulan-psl-2.0", "mulan", r"mulan(?: permissive software| psl)?", r"mulanpsl 2 0"),
    ("ecl-2.0", "educational", r"educational community", r"ecl 2 0"),
    ("blueoak-1.0.0", "blue", r"blue oak model", r"blueoak 1 0 0"),
    ("vim", "vim", r"vim", r"vim"),
    ("curl", "curl", r"curl", r"curl"),
    ("unicode-3.0", "unicode", r"unicode(?: v3)?", r"unicode 3 0"),
    ("w3c", "w3c", r"w3c(?: software)?(?: notice and)?", r"w3c"),
    ("hpnd", "historical", r"historical permission notice and disclaimer", r"hpnd"),
    ("json", "json", r"json", r"json"),
    ("ijg", "jpeg", r"independent jpeg group", r"ijg"),
    ("sleepycat", "sleepycat", r"sleepycat", r"sleepycat"),
)

# form, priority, confidence; {name} and {spdx} stand for the columns above
FORMS = (
    (r"spdx license identifier {spdx}", 4, 1.0),
    (r"(?:licensed|released|distributed|available|published) under(?: the)?(?: terms)?(?: of)?(?: the)?(?: gnu)? {name}(?: licen[sc]e)?(?: agreement)?", 3, 0.95),
    (r"{name} licen[sc]e(?: agreement)?(?: version \d+(?: \d+)?| v\d+(?: \d+)?)?", 2, 0.9),
    (r"(?:license|licence) {name}", 1, 0.7),
)

# sentences of the notices themselves
NOTICES = (
    Rule("mit", "sublicense", 5, 1.0, r"permission is hereby granted free of charge to any person obtaining a copy"),
    Rule("mit", "noninfringement", 4, 0.8, r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    Rule("isc", "purpose", 5, 1.0, r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Rule("bsd", "redistribution", 5, 0.9, r"redistribution and use in source and binary forms with or without modification are permitted"),
    Rule("bsd-3-clause", "endorse", 5, 1.0, r"neither the name of .{1,80}? nor the names of its contributors may be used to endorse or promote"),
    Rule("bsd-4-clause", "advertising", 5, 1.0, r"all advertising materials mentioning features or use of this software must display"),
    Rule("apache-2.0", "apache", 5, 1.0, r"you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    Rule("apache-2.0", "apache", 4, 1.0, r"apache org licenses license 2 0"),
    Rule("gpl", "redistribute", 5, 0.9, r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    Rule("lgpl", "redistribute", 5, 0.95, r"you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    Rule("agpl", "redistribute", 5, 0.95, r"you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    Rule("mpl-2.0", "mozilla", 5, 1.0, r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    Rule("epl-1.0", "eclipse", 5, 1.0, r"this program and the accompanying materials are made available under the terms of the eclipse public license v1 0"),
    Rule("unlicense", "unencumbered", 5, 1.0, r"this is free and unencumbered software released into the public domain"),
    Rule("public-domain", "domain", 3, 0.8, r"(?:dedicated to|released into|placed in|in) the public domain"),
    Rule("zlib", "misrepresented", 5, 1.0, r"the origin of this software must not be misrepresented"),
    Rule("bsl-1.0", "boost", 5, 1.0, r"distributed under the boost software license version 1 0"),
    Rule("wtfpl", "fuck", 5, 1.0, r"you just do what the fuck you want to"),
    Rule("cc0-1.0", "waived", 5, 1.0, r"waived all copyright and related or neighboring rights"),
    Rule("proprietary", "reserved", 2, 0.6, r"all rights reserved"),
    Rule("proprietary", "proprietary", 3, 0.8, r"(?:confidential and proprietary|proprietary and confidential)"),
    Rule("json", "evil", 5, 1.0, r"the software shall be used for good not evil"),
    Rule("ofl-1.1", "font", 5, 1.0, r"this font software is licensed under the sil open font license version 1 1"),
    Rule("copyright", "copyright", 0, 0.3, r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)?"),
)


def all_rules():
    """Every rule, once, in order of priority and then of writing."""
    made = [
        Rule(label, "spdx" if "spdx" in form else keyword, priority, confidence,
             form.format(name=name, spdx=spdx))
        for form, priority, confidence in FORMS
        for label, keyword, name, spdx in NAMES
    ]
    unique = dict.fromkeys([*NOTICES, *made])
    return sorted(unique, key=lambda r: -r.priority)


# Words that every text with a match holds at least one of; single words, as line ends may stand between two.
GATES = ("licen", "copyright", "warrant", "permission", "redistribut", "proprietary", "reserved")

# Further ones that only count together, as each alone is in many texts.
JOINT_GATES = tuple((f"{verb}", "under") for verb in ("released", "distributed", "available", "published"))

# Words that are in too many texts to try a rule for, where another word does.
COMMON = frozenset("license licence agreement under the terms of version public software to in and or is for not with "
                   "this be you may a it all general open source free by no gnu what 0 1 2 3 4".split())


def _strings(node):
    """All strings that a parsed pattern matches; NUL stands for what is not one fixed character."""
    made = [""]
    for op, value in node:
        name = str(op)
        if name == "LITERAL":
            ends = [chr(value)]
        elif name == "BRANCH":
            ends = [x for part in value[1] for x in _strings(part)]
        elif name == "SUBPATTERN":
            ends = _strings(value[-1])
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and value[:2] == (0, 1):
            ends = ["", *_strings(value[2])]
        elif name == "IN" and all(str(kind) == "LITERAL" and chr(c).isalpha() for kind, c in value):
            ends = [chr(c) for _, c in value]
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and value[0] > 0 or name in ("IN", "ANY"):
            ends = ["\0"]
        else:
            raise ValueError(f"no fixed words: {name}")
        made = [a + b for a in made for b in dict.fromkeys(ends)]
    return made


@lru_cache(maxsize=4096)
def word_sets(pattern):
    """The sets of whole words that matches of `pattern` hold for certain, one of them each match."""
    return frozenset(frozenset(w for w in text.split(" ") if w and "\0" not in w) for text in _strings(_parser.parse(pattern)))


@lru_cache(maxsize=4096)
def keywords(rule):
    """Words of which every match of the rule holds one: its keyword where it does, and others for the rest."""
    left, found = list(word_sets(rule.pattern)), []
    if any(rule.keyword in words for words in left):
        found.append(rule.keyword)
    while left := [words for words in left if not words & set(found)]:
        counts = Counter(w for words in left for w in words)
        if not counts or not all(left):
            return []  # no word is certain: always tried
        found.append(max(counts, key=lambda w: (w not in COMMON, counts[w], len(w), w)))
    return found


@lru_cache(maxsize=8)
def gates(rules, phrases=()):
    """Groups of words: a text that lacks a word of each group holds no match and no phrase.

    A match that no fixed group is part of has a keyword of its rule as a group.
    """
    fixed, more = [*((g,) for g in GATES), *JOINT_GATES], set()
    for rule in [*rules, *(Rule("", "", 0, 0.0, phrase) for phrase in phrases)]:
        for words in word_sets(rule.pattern):
            if not any(all(any(g in w for w in words) for g in group) for group in fixed):
                own = words & set(keywords(rule))
                more.add((min(own),) if own else ("",))
    return [*fixed, *sorted(more)]
