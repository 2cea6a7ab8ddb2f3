"""Signature rules of the license scan.

A rule is (label, priority, keyword, pattern). The keyword is the first word of every text that
the pattern matches; the pattern is read from there on, over words joined by single spaces, in
the subset of regular expressions that Java and RE2 share. Priority 1 is a declared identifier,
2 a full title, 3 a notice or an address, 4 a short name. The rules are hand-written for each
license: its title, its identifiers, its address, its short names.
"""

from __future__ import annotations

import re

#: label: titles | identifiers (words after "spdx license identifier") | addresses | short names; each is a list of patterns.
LICENSES: dict[str, tuple[list[str], list[str], list[str], list[str]]] = {
    "mit": (["mit license", "mit expat license", "expat license", "x11 license"], ["mit", "mit 0", "x11"], ["opensource org licenses mit"], ["mit licensed", "mit style license"]),
    "apache": (["apache license", "apache software license", "asl (?:1 1|2 0)"], ["apache (?:1 0|1 1|2 0)"], ["apache org licenses license 2 0", "www apache org licenses"], ["apache (?:1|2)(?: \\d)? licen[sc]e", "apache licensed"]),
    "gpl": (["general public licen[sc]e", "gnu general public licen[sc]e", "gnu gpl"], ["gpl (?:1 0|2 0|3 0)(?: only| or later)?"], ["gnu org licenses (?:old licenses )?gpl"], ["gplv[123]", "gpl v ?[123]", "gpl version [123]", "gpl licensed"]),
    "lgpl": (["lesser general public licen[sc]e", "library general public licen[sc]e", "gnu (?:lesser|library) general public licen[sc]e", "gnu lgpl"], ["lgpl (?:2 0|2 1|3 0)(?: only| or later)?"], ["gnu org licenses (?:old licenses )?lgpl"], ["lgplv[23]", "lgpl v ?[23]", "lgpl version [23]", "lgpl licensed"]),
    "agpl": (["affero general public licen[sc]e", "gnu affero general public licen[sc]e", "gnu agpl"], ["agpl (?:1 0|3 0)(?: only| or later)?"], ["gnu org licenses agpl"], ["agplv[13]", "agpl v ?[13]", "agpl licensed"]),
    "gfdl": (["free documentation licen[sc]e", "gnu free documentation licen[sc]e", "gnu fdl"], ["gfdl 1 [123](?: only| or later)?"], ["gnu org licenses (?:old licenses )?fdl"], ["gfdl"]),
    "bsd": (["bsd licen[sc]e", "bsd (?:2|3|4) clause(?: licen[sc]e)?", "(?:new|modified|simplified|revised) bsd licen[sc]e", "berkeley software distribution licen[sc]e"], ["bsd (?:1|2|3|4) clause", "0bsd"], ["opensource org licenses bsd"], ["bsd style licen[sc]e", "bsd licensed"]),
    "isc": (["isc licen[sc]e", "internet software consortium licen[sc]e"], ["isc"], ["opensource org licenses isc"], ["isc licensed"]),
    "mpl": (["mozilla public licen[sc]e"], ["mpl (?:1 0|1 1|2 0)"], ["mozilla org mpl"], ["mplv[12]", "mpl (?:1|2) \\d"]),
    "epl": (["eclipse public licen[sc]e"], ["epl (?:1|2) 0"], ["eclipse org legal epl"], ["eplv[12]", "epl (?:1|2) 0"]),
    "edl": (["eclipse distribution licen[sc]e"], ["edl 1 0"], ["eclipse org org documents edl"], ["edl v10"]),
    "cpl": (["common public licen[sc]e"], ["cpl 1 0"], ["opensource org licenses cpl"], ["cplv1"]),
    "cddl": (["common development and distribution licen[sc]e"], ["cddl 1 [01]"], ["opensource org licenses cddl"], ["cddl v1", "cddl 1 [01]"]),
    "ipl": (["ibm public licen[sc]e"], ["ipl 1 0"], ["opensource org licenses ibmpl"], ["iplv1"]),
    "ms-pl": (["microsoft public licen[sc]e"], ["ms pl"], ["opensource org licenses ms pl"], ["ms pl licensed"]),
    "ms-rl": (["microsoft reciprocal licen[sc]e"], ["ms rl"], ["opensource org licenses ms rl"], ["ms rl licensed"]),
    "bsl": (["boost software licen[sc]e"], ["bsl 1 0"], ["boost org license 1 0"], ["boost licensed"]),
    "busl": (["business source licen[sc]e"], ["busl 1 1"], ["mariadb com bsl11"], ["busl 1 1"]),
    "zlib": (["zlib licen[sc]e", "zlib libpng licen[sc]e"], ["zlib"], ["opensource org licenses zlib", "zlib net zlib license"], ["zlib licensed"]),
    "libpng": (["libpng licen[sc]e"], ["libpng(?: 2 0)?"], ["libpng org pub png src libpng license"], ["libpng licensed"]),
    "unlicense": (["unlicense"], ["unlicense"], ["unlicense org"], ["released into the public domain by its author"]),
    "wtfpl": (["what the fuck you want to public licen[sc]e"], ["wtfpl"], ["wtfpl net"], ["wtfpl"]),
    "cc0": (["cc0 1 0 universal", "creative commons zero"], ["cc0 1 0"], ["creativecommons org publicdomain zero"], ["cc0"]),
    "cc-by": (["creative commons attribution(?: \\d \\d)?(?: international| unported| generic)? licen[sc]e", "creative commons attribution \\d \\d"], ["cc by \\d \\d"], ["creativecommons org licenses by \\d"], ["cc by \\d \\d"]),
    "cc-by-sa": (["creative commons attribution share ?alike"], ["cc by sa \\d \\d"], ["creativecommons org licenses by sa"], ["cc by sa"]),
    "cc-by-nc": (["creative commons attribution non ?commercial"], ["cc by nc \\d \\d"], ["creativecommons org licenses by nc"], ["cc by nc"]),
    "cc-by-nd": (["creative commons attribution no ?deriv(?:ative)?s"], ["cc by nd \\d \\d"], ["creativecommons org licenses by nd"], ["cc by nd"]),
    "cc-by-nc-sa": (["creative commons attribution non ?commercial share ?alike"], ["cc by nc sa \\d \\d"], ["creativecommons org licenses by nc sa"], ["cc by nc sa"]),
    "cc-by-nc-nd": (["creative commons attribution non ?commercial no ?deriv(?:ative)?s"], ["cc by nc nd \\d \\d"], ["creativecommons org licenses by nc nd"], ["cc by nc nd"]),
    "artistic": (["artistic licen[sc]e", "perl artistic licen[sc]e"], ["artistic (?:1|2) 0"], ["opensource org licenses artistic"], ["artistic licensed"]),
    "python": (["python software foundation licen[sc]e", "psf licen[sc]e"], ["psf 2 0", "python 2 0"], ["python org psf license", "docs python org 3 license"], ["psf licensed"]),
    "php": (["php licen[sc]e"], ["php 3 0(?:1)?"], ["php net license"], ["php licensed"]),
    "ruby": (["ruby licen[sc]e"], ["ruby"], ["ruby lang org en about license"], ["ruby licensed"]),
    "openssl": (["openssl licen[sc]e"], ["openssl"], ["openssl org source license"], ["openssl licensed"]),
    "ofl": (["sil open font licen[sc]e", "open font licen[sc]e"], ["ofl 1 [01]"], ["scripts sil org ofl"], ["ofl licensed"]),
    "odbl": (["open database licen[sc]e", "open data commons open database licen[sc]e"], ["odbl 1 0"], ["opendatacommons org licenses odbl"], ["odbl"]),
    "odc-by": (["open data commons attribution licen[sc]e"], ["odc by 1 0"], ["opendatacommons org licenses by"], ["odc by"]),
    "pddl": (["open data commons public domain dedication"], ["pddl 1 0"], ["opendatacommons org licenses pddl"], ["pddl"]),
    "eupl": (["european union public licen[sc]e"], ["eupl 1 [012]"], ["joinup ec europa eu (?:software page|collection) eupl"], ["euplv1", "eupl v 1"]),
    "cecill": (["cecill licen[sc]e", "cecill free software licen[sc]e"], ["cecill (?:1 0|1 1|2 0|2 1|b|c)"], ["cecill info"], ["cecill licensed"]),
    "osl": (["open software licen[sc]e"], ["osl (?:1|2|3) [01]"], ["opensource org licenses osl"], ["osl v3"]),
    "afl": (["academic free licen[sc]e"], ["afl (?:1|2|3) [012]"], ["opensource org licenses afl"], ["afl v3"]),
    "ecl": (["educational community licen[sc]e"], ["ecl (?:1|2) 0"], ["opensource org licenses ecl"], ["ecl v2"]),
    "ncsa": (["university of illinois ncsa open source licen[sc]e", "ncsa open source licen[sc]e"], ["ncsa"], ["opensource org licenses ncsa"], ["ncsa licensed"]),
    "postgresql": (["postgresql licen[sc]e"], ["postgresql"], ["postgresql org about licence"], ["postgresql licensed"]),
    "vim": (["vim licen[sc]e"], ["vim"], ["vimdoc sourceforge net htmldoc uganda"], ["vim licensed"]),
    "w3c": (["w3c software notice and licen[sc]e", "w3c software licen[sc]e"], ["w3c"], ["w3 org consortium legal copyright software"], ["w3c licensed"]),
    "curl": (["curl licen[sc]e"], ["curl"], ["curl se docs copyright"], ["curl licensed"]),
    "sleepycat": (["sleepycat licen[sc]e"], ["sleepycat"], ["opensource org licenses sleepycat"], ["sleepycat licensed"]),
    "qpl": (["q public licen[sc]e"], ["qpl 1 0"], ["opensource org licenses qtpl"], ["qpl licensed"]),
    "sspl": (["server side public licen[sc]e"], ["sspl 1 0"], ["mongodb com licensing server side public license"], ["sspl v1", "ssplv1"]),
    "elastic": (["elastic licen[sc]e"], ["elastic 2 0"], ["elastic co licensing elastic license"], ["elastic licensed"]),
    "public-domain": (["public domain dedication"], ["licenseref public domain"], ["creativecommons org publicdomain mark"], ["dedicated to the public domain", "placed in the public domain", "released into the public domain"]),
    "proprietary": (["rights reserved", "proprietary licen[sc]e"], ["licenseref proprietary"], ["proprietary and confidential"], ["unauthorized copying", "commercial licen[sc]e"]),
    "permission-notice": (["permission is hereby granted free of charge", "permission to use copy modify and(?: or)? distribute this software"], ["licenseref permission"], ["above copyright notice and this permission notice"], ["redistribution and use in source and binary forms"]),
    "copyleft-notice": (["can redistribute it and or modify it under the terms"], ["licenseref copyleft"], ["either version \\d of the licen[sc]e or"], ["should have received a copy of the gnu"]),
}

#: The three phrases whose detections always stay.
BASE = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
#: Words a pattern may cover.
REACH = 16


def _leads(pattern: str) -> list[str]:
    """The words that a match of the pattern can begin with: its first word, or each of its first group's."""
    head = pattern.split(" ")[0]
    if pattern.startswith("(?:"):
        return [w.split(" ")[0] for w in pattern[3 : pattern.index(")")].split("|")]
    if head.endswith("[123]") or head.endswith("[23]") or head.endswith("[13]") or head.endswith("[12]"):
        stem, _, digits = head[:-1].partition("[")
        return [stem + d for d in digits]
    return [head]


def rules() -> list[tuple[int, str, int, str, str]]:
    """(rule, label, priority, keyword, pattern), in order; a declared identifier begins with spdx."""
    out = []
    for label, (titles, identifiers, addresses, names) in LICENSES.items():
        for priority, patterns in ((2, titles), (1, [f"spdx license identifier {x}" for x in identifiers]), (3, addresses), (4, names)):
            out += [(label, priority, w, p) for p in patterns for w in _leads(p)]
    return [(i, label, priority, word, f"^(?:{p})(?: |$)") for i, (label, priority, word, p) in enumerate(out)]


def gate() -> str:
    """A pattern that every text in which a rule can match holds: cheap to try, it branches by first letter.

    A rule that names a licen(s/c)e is gated by that word, any other by its longest word.
    """
    words = set()
    for _, _, _, _, pattern in rules():
        plain = re.sub(r"\[[^]]*\]|\(\?:[^)]*\)\??|\\d|[?^]|\(\?.*", "\n", pattern.removesuffix("(?: |$)").removeprefix("^(?:").removesuffix(")"))
        words.add("licen" if re.search(r"(?:^|[ (|])licen", pattern) else max(re.findall(r"[a-z0-9]+", plain), key=len))
    words = {w for w in words if not any(w != v and w.startswith(v) for v in words)}
    letters = sorted({w[0] for w in words})
    return "(?i)(?<![0-9A-Za-z])(?:" + "|".join(f"{c}(?:{'|'.join(sorted(w[1:] for w in words if w[0] == c))})" for c in letters) + ")"
