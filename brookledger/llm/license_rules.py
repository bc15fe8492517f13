"""Signature rules for licence texts: (priority, label, pattern, keyword).

Patterns are for lower-cased text. A rule is tried only on texts that hold its
keyword. Rules are written by form: each form is a way in which people name a
licence, and each licence fills it with its own names.
"""

from __future__ import annotations

#: What stands between words, and a word's characters.
GAP = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
WORD = r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]"

#: The base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Licences: label, names in words, identifiers, and addresses (host and path).
LICENCES: list[tuple[str, tuple[str, ...], tuple[str, ...], tuple[str, ...]]] = [
    ("gpl", ("gnu general public licen[cs]e", "gnu gpl"), ("gpl",), ("gnu.org/licenses/gpl",)),
    ("gpl-2.0", ("gnu general public licen[cs]e,? version 2", "gnu general public licen[cs]e v2", "gnu gpl,? version 2", "gnu gpl v2", "gnu gpl 2.0"), ("gpl-2.0", "gpl-2.0-only", "gpl-2.0-or-later", "gplv2"), ("gnu.org/licenses/old-licenses/gpl-2.0",)),
    ("gpl-3.0", ("gnu general public licen[cs]e,? version 3", "gnu general public licen[cs]e v3", "gnu gpl,? version 3", "gnu gpl v3", "gnu gpl 3.0"), ("gpl-3.0", "gpl-3.0-only", "gpl-3.0-or-later", "gplv3"), ("gnu.org/licenses/gpl-3.0",)),
    ("lgpl", ("gnu lesser general public licen[cs]e", "gnu library general public licen[cs]e"), ("lgpl", "lgpl-2.1", "lgpl-3.0", "lgplv3"), ("gnu.org/licenses/lgpl",)),
    ("lgpl-2.1", ("gnu lesser general public licen[cs]e,? version 2.1", "lesser general public licen[cs]e,? version 2.1", "gnu lesser general public licen[cs]e v2.1", "lesser general public licen[cs]e v2.1", "gnu lgpl,? version 2.1", "gnu lgpl v2.1"), ("lgpl-2.1-only", "lgpl-2.1-or-later"), ("gnu.org/licenses/old-licenses/lgpl-2.1",)),
    ("lgpl-3.0", ("gnu lesser general public licen[cs]e,? version 3", "lesser general public licen[cs]e,? version 3", "gnu lesser general public licen[cs]e v3", "lesser general public licen[cs]e v3", "gnu lgpl,? version 3", "gnu lgpl v3"), ("lgpl-3.0-only", "lgpl-3.0-or-later"), ("gnu.org/licenses/lgpl-3.0",)),
    ("agpl", ("gnu affero general public licen[cs]e",), ("agpl", "agpl-3.0", "agplv3"), ("gnu.org/licenses/agpl",)),
    ("gfdl", ("gnu free documentation licen[cs]e",), ("gfdl", "gfdl-1.3"), ("gnu.org/licenses/fdl",)),
    ("apache", ("apache licen[cs]e", "apache software licen[cs]e"), ("apache",), ("apache.org/licenses",)),
    ("apache-2.0", ("apache licen[cs]e,? version 2", "apache licen[cs]e 2"), ("apache-2.0",), ("apache.org/licenses/license-2.0",)),
    ("mit", ("mit licen[cs]e", "expat licen[cs]e"), ("mit",), ("opensource.org/licenses/mit",)),
    ("bsd", ("bsd licen[cs]e", "bsd-style licen[cs]e"), ("bsd",), ("opensource.org/licenses/bsd-license",)),
    ("bsd-2-clause", ("2-clause bsd licen[cs]e", "simplified bsd licen[cs]e", "freebsd licen[cs]e"), ("bsd-2-clause",), ("opensource.org/licenses/bsd-2-clause",)),
    ("bsd-3-clause", ("3-clause bsd licen[cs]e", "new bsd licen[cs]e", "modified bsd licen[cs]e"), ("bsd-3-clause",), ("opensource.org/licenses/bsd-3-clause",)),
    ("isc", ("isc licen[cs]e",), ("isc",), ("opensource.org/licenses/isc",)),
    ("mpl", ("mozilla public licen[cs]e",), ("mpl", "mpl-1.1", "mpl-2.0"), ("mozilla.org/mpl",)),
    ("epl", ("eclipse public licen[cs]e",), ("epl", "epl-1.0", "epl-2.0"), ("eclipse.org/legal/epl",)),
    ("cddl", ("common development and distribution licen[cs]e",), ("cddl", "cddl-1.0"), ("opensource.org/licenses/cddl",)),
    ("cpl", ("common public licen[cs]e",), ("cpl-1.0",), ("opensource.org/licenses/cpl",)),
    ("artistic", ("artistic licen[cs]e",), ("artistic-1.0", "artistic-2.0"), ("opensource.org/licenses/artistic",)),
    ("zlib", ("zlib licen[cs]e", "zlib/libpng licen[cs]e"), ("zlib",), ("opensource.org/licenses/zlib",)),
    ("boost", ("boost software licen[cs]e",), ("bsl-1.0",), ("boost.org/license_1_0",)),
    ("unlicense", ("the unlicense",), ("unlicense",), ("unlicense.org",)),
    ("wtfpl", ("do what the fuck you want to public licen[cs]e",), ("wtfpl",), ("wtfpl.net",)),
    ("cc0", ("creative commons zero", "cc0 1.0 universal"), ("cc0", "cc0-1.0"), ("creativecommons.org/publicdomain/zero",)),
    ("cc-by", ("creative commons attribution", "cc by"), ("cc-by", "cc-by-3.0", "cc-by-4.0"), ("creativecommons.org/licenses/by/",)),
    ("cc-by-sa", ("creative commons attribution-sharealike", "cc by-sa"), ("cc-by-sa", "cc-by-sa-3.0", "cc-by-sa-4.0"), ("creativecommons.org/licenses/by-sa",)),
    ("cc-by-nc", ("creative commons attribution-noncommercial", "cc by-nc"), ("cc-by-nc", "cc-by-nc-4.0"), ("creativecommons.org/licenses/by-nc/",)),
    ("cc-by-nd", ("creative commons attribution-noderivatives", "cc by-nd"), ("cc-by-nd", "cc-by-nd-4.0"), ("creativecommons.org/licenses/by-nd",)),
    ("cc-by-nc-sa", ("creative commons attribution-noncommercial-sharealike", "cc by-nc-sa"), ("cc-by-nc-sa", "cc-by-nc-sa-4.0"), ("creativecommons.org/licenses/by-nc-sa",)),
    ("cc-by-nc-nd", ("creative commons attribution-noncommercial-noderivatives", "cc by-nc-nd"), ("cc-by-nc-nd", "cc-by-nc-nd-4.0"), ("creativecommons.org/licenses/by-nc-nd",)),
    ("odbl", ("open database licen[cs]e", "open data commons open database"), ("odbl", "odbl-1.0"), ("opendatacommons.org/licenses/odbl",)),
    ("pddl", ("public domain dedication and licen[cs]e",), ("pddl-1.0",), ("opendatacommons.org/licenses/pddl",)),
    ("ofl", ("sil open font licen[cs]e",), ("ofl-1.1",), ("scripts.sil.org/ofl",)),
    ("psf", ("python software foundation licen[cs]e",), ("psf-2.0", "python-2.0"), ("docs.python.org/3/license",)),
    ("ms-pl", ("microsoft public licen[cs]e",), ("ms-pl",), ("opensource.org/licenses/ms-pl",)),
    ("ms-rl", ("microsoft reciprocal licen[cs]e",), ("ms-rl",), ("opensource.org/licenses/ms-rl",)),
    ("eupl", ("european union public licen[cs]e",), ("eupl", "eupl-1.2"), ("joinup.ec.europa.eu/collection/eupl",)),
    ("osl", ("open software licen[cs]e",), ("osl-3.0",), ("opensource.org/licenses/osl",)),
    ("afl", ("academic free licen[cs]e",), ("afl-3.0",), ("opensource.org/licenses/afl",)),
    ("postgresql", ("postgresql licen[cs]e",), ("postgresql",), ("opensource.org/licenses/postgresql",)),
    ("openssl", ("openssl licen[cs]e",), ("openssl",), ("openssl.org/source/license",)),
    ("php", ("php licen[cs]e",), ("php-3.01",), ("php.net/license",)),
    ("sspl", ("server side public licen[cs]e",), ("sspl-1.0",), ("mongodb.com/licensing/server-side-public-license",)),
    ("busl", ("business source licen[cs]e",), ("busl-1.1",), ("mariadb.com/bsl",)),
    ("elastic", ("elastic licen[cs]e",), ("elastic-2.0",), ("elastic.co/licensing/elastic-license",)),
]

#: Sentences that belong to one licence text only: label, words, keyword.
SENTENCES: list[tuple[str, str, str]] = [
    ("mit", "permission is hereby granted, free of charge, to any person obtaining a copy", "hereby granted"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies", "permission notice"),
    ("isc", "permission to use, copy, modify, and/or distribute this software for any purpose", "permission to use"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use"),
    ("bsd-3-clause", "neither the name of .{1,80}? nor the names of its contributors", "neither the name"),
    ("gpl", "either version 2 of the license, or (?:\\(at your option\\) )?any later version", "any later version"),
    ("gpl", "this program is free software; you can redistribute it and/or modify", "free software"),
    ("gpl", "this program is distributed in the hope that it will be useful", "will be useful"),
    ("apache", "you may not use this file except in compliance with the license", "in compliance with"),
    ("apache", "distributed on an as is basis, without warranties or conditions of any kind", "as is basis"),
    ("zlib", "this software is provided as-is, without any express or implied warranty", "express or implied"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("public-domain", "(?:released|dedicated|placed) (?:in|in ?to) the public domain", "public domain"),
    ("mpl", "this source code form is subject to the terms of the mozilla public", "source code form"),
    ("cc0", "waives? all copyright and related rights", "related rights"),
    ("proprietary", "all rights reserved", "all rights reserved"),
    ("proprietary", "unauthorized copying of this file", "unauthorized copying"),
    ("proprietary", "confidential and proprietary", "proprietary"),
]


def words_pattern(phrase: str) -> str:
    """A phrase of words or small patterns, with any gap for each blank."""
    return rf"(?<!{WORD})" + GAP.join(p.strip(",") if p.strip(",") else p for p in phrase.split(" ")) + rf"(?!{WORD})"


def _exact(text: str) -> str:
    return text.replace(".", r"\.").replace("-", r"\-").replace("+", r"\+")


def _keyword(name: str) -> str:
    """The longest part of a name that is plain text."""
    import re

    return max(re.split(r"[^a-z0-9]+", re.sub(r"licen\[cs\]e|[?()\[\]|]", " ", name)), key=len)


def build_rules() -> list[tuple[int, str, str, str]]:
    """All rules; a smaller priority wins where two detections are the same span."""
    rules: list[tuple[int, str, str, str]] = []
    for label, names, identifiers, addresses in LICENCES:
        for name in names:
            word = _keyword(name)
            spaced = words_pattern(name.replace("-", " ").replace("/", " ").replace(",?", ""))
            rules.append((20, label, spaced, word))
            rules.append((10, label, rf"(?:licen[cs]ed|released|distributed|available){GAP}under{GAP}(?:the{GAP}|a{GAP})?{spaced}", word))
        for name in identifiers:
            exact = _exact(name)
            rules.append((5, label, rf"spdx\-license\-identifier:[ \t]*{exact}(?![\w.+-])", "spdx"))
            rules.append((30, label, rf"licen[cs]e[ \t]*[:=][ \t]*[\"']?{exact}(?![\w.+-])", "licen"))
            rules.append((15, label, rf"(?:licen[cs]ed|released|distributed|available){GAP}under{GAP}(?:the{GAP}|a{GAP})?{exact}(?![\w.+-])", "under"))
        for address in addresses:
            rules.append((8, label, _exact(address).replace("/", "/+"), max(address.split("/")[0].split("."), key=len)))
    for label, sentence, keyword in SENTENCES:
        rules.append((1, label, words_pattern(sentence), keyword.split(" ")[-1]))
    return rules
