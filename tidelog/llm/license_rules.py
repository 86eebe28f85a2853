"""Signature rules for licence statements, over texts in word form.

Word form: lower-cased words with single spaces between and around them.  A rule
is (id, label, tier, keyword, pattern, confidence).  Lower tiers have priority;
inside a tier the longer detection, then the earlier rule.  The keyword is a
literal that every match of the pattern contains; it gates the pattern.
"""

from __future__ import annotations

from typing import NamedTuple

from .license_clauses import TEXTS


class Rule(NamedTuple):
    id: int
    label: str
    tier: int
    keyword: str
    pattern: str
    confidence: float


# (label, keyword, identifier in word form, name with its variants and versions).
FAMILIES = [
    ("agpl-1.0", "affero", "agpl 1 0(?: only| or later)?", r"affero general public licen[cs]e,?(?: version| v)? ?1(?: 0)?"),
    ("agpl-3.0", "affero", "agpl 3 0(?: only| or later)?", r"(?:gnu )?affero general public licen[cs]e(?: version| v)? ?3(?: 0)?"),
    ("agpl", "affero", "agpl", r"(?:gnu )?affero general public licen[cs]e"),
    ("lgpl-2.0", "gnu", "lgpl 2 0(?: only| or later)?", r"gnu library general public licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("lgpl-2.1", "lesser", "lgpl 2 1(?: only| or later)?", r"(?:gnu )?lesser general public licen[cs]e(?: version| v)? ?2 1"),
    ("lgpl-3.0", "lesser", "lgpl 3 0(?: only| or later)?", r"(?:gnu )?lesser general public licen[cs]e(?: version| v)? ?3(?: 0)?"),
    ("lgpl", "lesser", "lgpl", r"(?:gnu )?lesser general public licen[cs]e"),
    ("gpl-1.0", "general public", "gpl 1 0(?: only| or later)?", r"(?:gnu )?general public licen[cs]e(?: version| v)? ?1(?: 0)?"),
    ("gpl-2.0", "general public", "gpl 2 0(?: only| or later)?", r"(?:gnu )?general public licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("gpl-3.0", "general public", "gpl 3 0(?: only| or later)?", r"(?:gnu )?general public licen[cs]e(?: version| v)? ?3(?: 0)?"),
    ("gpl-family", "general public", "gpl", r"gnu general public licen[cs]e"),
    ("gfdl-1.1", "free documentation", "gfdl 1 1(?: only| or later)?", r"(?:gnu )?free documentation licen[cs]e(?: version| v)? ?1 1"),
    ("gfdl-1.2", "free documentation", "gfdl 1 2(?: only| or later)?", r"(?:gnu )?free documentation licen[cs]e(?: version| v)? ?1 2"),
    ("gfdl-1.3", "free documentation", "gfdl 1 3(?: only| or later)?", r"(?:gnu )?free documentation licen[cs]e(?: version| v)? ?1 3"),
    ("gfdl", "free documentation", "gfdl", r"gnu free documentation licen[cs]e"),
    ("apache-1.0", "apache", "apache 1 0", r"apache (?:software )?licen[cs]e(?: version| v)? ?1 0"),
    ("apache-1.1", "apache", "apache 1 1", r"apache (?:software )?licen[cs]e(?: version| v)? ?1 1"),
    ("apache-2.0", "apache", "apache 2 0", r"apache (?:software )?(?:public )?licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("apache", "apache", "apache", r"apache (?:software )?licen[cs]e"),
    ("mit", "mit", "mit", r"(?:mit|mit x11|x11 mit)(?: style)? licen[cs]e"),
    ("mit", "expat", "expat", r"expat(?: style)? licen[cs]e"),
    ("mit-0", "mit", "mit 0", r"mit no attribution(?: licen[cs]e)?"),
    ("x11", "x11", "x11", r"x11 (?:consortium )?licen[cs]e"),
    ("isc", "isc", "isc", r"isc licen[cs]e"),
    ("bsd-0-clause", "bsd", "0bsd", r"(?:zero|0) clause bsd(?: licen[cs]e)?|bsd (?:zero|0) clause(?: licen[cs]e)?"),
    ("bsd-1-clause", "bsd", "bsd 1 clause", r"(?:one|1) clause bsd(?: licen[cs]e)?|bsd (?:one|1) clause(?: licen[cs]e)?"),
    ("bsd-2-clause", "bsd", "bsd 2 clause", r"(?:two|2) clause bsd(?: licen[cs]e)?|bsd (?:two|2) clause(?: licen[cs]e)?|simplified bsd(?: licen[cs]e)?|freebsd licen[cs]e"),
    ("bsd-3-clause", "bsd", "bsd 3 clause", r"(?:three|3) clause bsd(?: licen[cs]e)?|bsd (?:three|3) clause(?: licen[cs]e)?|(?:new|revised|modified) bsd(?: licen[cs]e)?"),
    ("bsd-4-clause", "bsd", "bsd 4 clause", r"(?:four|4) clause bsd(?: licen[cs]e)?|bsd (?:four|4) clause(?: licen[cs]e)?|(?:original|old) bsd(?: licen[cs]e)?"),
    ("bsd", "bsd", "bsd", r"(?:the )?bsd(?: style)? licen[cs]e"),
    ("mpl-1.0", "mozilla", "mpl 1 0", r"mozilla public licen[cs]e(?: version| v)? ?1 0"),
    ("mpl-1.1", "mozilla", "mpl 1 1", r"mozilla public licen[cs]e(?: version| v)? ?1 1"),
    ("mpl-2.0", "mozilla", "mpl 2 0", r"mozilla public licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("mpl", "mozilla", "mpl", r"mozilla public licen[cs]e"),
    ("epl-1.0", "eclipse", "epl 1 0", r"eclipse public licen[cs]e(?: version| v)? ?1(?: 0)?"),
    ("epl-2.0", "eclipse", "epl 2 0", r"eclipse public licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("epl", "eclipse", "epl", r"eclipse public licen[cs]e"),
    ("edl-1.0", "eclipse", "edl 1 0", r"eclipse distribution licen[cs]e(?: version| v)?(?: 1 0)?"),
    ("cddl-1.0", "common development", "cddl 1 0", r"common development and distribution licen[cs]e(?: version| v)?(?: 1 0)?"),
    ("cddl-1.1", "common development", "cddl 1 1", r"common development and distribution licen[cs]e(?: version| v)? ?1 1"),
    ("cpl-1.0", "common public", "cpl 1 0", r"common public licen[cs]e(?: version| v)?(?: 1 0)?"),
    ("cpal-1.0", "common public attribution", "cpal 1 0", r"common public attribution licen[cs]e(?: version| v)?(?: 1 0)?"),
    ("ipl-1.0", "public licen", "ipl 1 0", r"ibm public licen[cs]e(?: version| v)?(?: 1 0)?"),
    ("apsl-2.0", "public source", "apsl 2 0", r"apple public source licen[cs]e(?: version| v)?(?: 2 0)?"),
    ("eupl-1.1", "european union", "eupl 1 1", r"european union public licen[cs]e(?: version| v)? ?1 1"),
    ("eupl-1.2", "european union", "eupl 1 2", r"european union public licen[cs]e(?: version| v)? ?1 2"),
    ("eupl", "european union", "eupl", r"european union public licen[cs]e"),
    ("artistic-1.0", "artistic", "artistic 1 0", r"artistic licen[cs]e(?: version| v)? ?1(?: 0)?"),
    ("artistic-2.0", "artistic", "artistic 2 0", r"artistic licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("artistic", "artistic", "artistic", r"(?:perl |clarified )?artistic licen[cs]e"),
    ("zlib", "zlib", "zlib", r"zlib(?: libpng)? licen[cs]e"),
    ("libpng", "libpng", "libpng", r"libpng licen[cs]e(?: version 2)?"),
    ("bsl-1.0", "boost", "bsl 1 0", r"boost software licen[cs]e(?: version| v)?(?: 1 0)?"),
    ("busl-1.1", "business source", "busl 1 1", r"business source licen[cs]e(?: version| v)?(?: 1 1)?"),
    ("sspl-1.0", "server side public", "sspl 1 0", r"server side public licen[cs]e(?: version| v)?(?: 1(?: 0)?)?"),
    ("elastic-2.0", "elastic", "elastic 2 0", r"elastic licen[cs]e(?: version| v)?(?: 2(?: 0)?)?"),
    ("unlicense", "unlicense", "unlicense", r"the unlicense"),
    ("wtfpl", "what the", "wtfpl", r"do what the (?:fuck|f) you want to public licen[cs]e"),
    ("python-2.0", "python", "python 2 0|psf 2 0", r"python software foundation licen[cs]e(?: version 2)?"),
    ("ruby", "ruby", "ruby", r"ruby(?: s)? licen[cs]e"),
    ("php-3.01", "php", "php 3 0 ?1", r"php licen[cs]e(?: version| v)?(?: 3 01?)?"),
    ("postgresql", "postgresql", "postgresql", r"postgresql licen[cs]e"),
    ("openssl", "openssl", "openssl", r"openssl licen[cs]e"),
    ("ofl-1.1", "open font", "ofl 1 1", r"(?:sil )?open font licen[cs]e(?: version| v)?(?: 1 1)?"),
    ("ncsa", "ncsa", "ncsa", r"(?:university of illinois )?(?:illinois )?ncsa open source licen[cs]e"),
    ("upl-1.0", "universal permissive", "upl 1 0", r"universal permissive licen[cs]e(?: version| v)?(?: 1 0)?"),
    ("ms-pl", "microsoft", "ms pl", r"microsoft public licen[cs]e"),
    ("ms-rl", "microsoft", "ms rl", r"microsoft reciprocal licen[cs]e"),
    ("afl-3.0", "academic free", "afl 3 0", r"academic free licen[cs]e(?: version| v)?(?: 3 0)?"),
    ("osl-3.0", "open software", "osl 3 0", r"open software licen[cs]e(?: version| v)?(?: 3 0)?"),
    ("ecl-2.0", "educational community", "ecl 2 0", r"educational community licen[cs]e(?: version| v)?(?: 2 0)?"),
    ("mulan-2.0", "mulan", "mulanpsl 2 0", r"mulan (?:permissive software licen[cs]e|psl)(?: version| v)? ?2?"),
    ("odbl-1.0", "open database", "odbl 1 0", r"open database licen[cs]e(?: version| v)?(?: 1 0)?"),
    ("odc-by-1.0", "open data commons", "odc by 1 0", r"open data commons attribution licen[cs]e(?: version| v)?(?: 1 0)?"),
    ("pddl-1.0", "public domain", "pddl 1 0", r"public domain dedication and licen[cs]e(?: version| v)?(?: 1 0)?"),
    ("ogl-uk-3.0", "open government", "ogl uk 3 0", r"open government licen[cs]e(?: version| v)?(?: 3 0)?"),
    ("cc0-1.0", "cc0", "cc0 1 0", r"cc0(?: 1 0)?(?: universal)?"),
    ("openrail-m", "rail", "openrail", r"(?:creativeml |bigscience )?open ?rail(?: m)?(?: licen[cs]e)?"),
    ("llama-community", "llama", "llama 2|llama 3", r"llama [23](?: [0-9])? community licen[cs]e(?: agreement)?"),
]

# Creative Commons: (label, parts of the short form, parts of the long form).
COMMONS = [
    ("cc-by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
    ("cc-by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("cc-by-nc", "by nc", "attribution non ?commercial"),
    ("cc-by-nd", "by nd", "attribution no ?deriv(?:ative)?s?(?: works)?"),
    ("cc-by-sa", "by sa", "attribution share ?alike"),
    ("cc-by-only", "by", "attribution"),
]
COMMONS_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]

# Clauses of licence texts and notices: (label, tier, keyword, pattern, confidence).
CLAUSES = [
    ("mit", 0, "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy", 1.0),
    ("mit", 1, "associated documentation files", r"copy of this software and associated documentation files", 0.9),
    ("isc", 0, "to use copy modify", r"permission to use copy modify and or distribute this software for any purpose with or without fee", 1.0),
    ("bsd-2-clause", 1, "redistributions of source code", r"redistributions of source code must retain the above copyright notice", 0.85),
    ("bsd-2-clause", 1, "redistributions in binary form", r"redistributions in binary form must reproduce the above copyright notice", 0.85),
    ("bsd-3-clause", 0, "endorse or promote", r"neither the name of .{1,80}? may be used to endorse or promote products derived", 0.95),
    ("bsd-4-clause", 0, "all advertising materials", r"all advertising materials mentioning features or use of this software", 0.98),
    ("apache-2.0", 0, "you may not use this file", r"you may not use this file except in compliance with the license", 0.98),
    ("apache-2.0", 0, "apache org licenses", r"(?:https? )?(?:www )?apache org licenses license 2 0(?: txt| html)?", 0.98),
    ("gpl-family", 1, "free software foundation", r"under the terms of the gnu general public licen[cs]e as published by the free software foundation", 0.98),
    ("lgpl", 1, "free software foundation", r"under the terms of the gnu lesser general public licen[cs]e as published by the free software foundation", 0.98),
    ("agpl", 1, "free software foundation", r"under the terms of the gnu affero general public licen[cs]e as published by the free software foundation", 0.98),
    ("gpl-family", 2, "gnu org licenses", r"(?:www )?gnu org licenses gpl(?: [0-9] 0)?(?: html| txt)?", 0.9),
    ("lgpl", 2, "gnu org licenses", r"(?:www )?gnu org licenses lgpl(?: [0-9] [01])?(?: html| txt)?", 0.9),
    ("agpl", 2, "gnu org licenses", r"(?:www )?gnu org licenses agpl(?: [0-9] 0)?(?: html| txt)?", 0.9),
    ("gfdl", 2, "gnu org licenses", r"(?:www )?gnu org licenses fdl(?: [0-9] [0-9])?(?: html| txt)?", 0.9),
    ("mpl-2.0", 0, "mozilla org", r"mozilla org mpl 2 0", 0.98),
    ("mpl", 2, "mozilla org", r"mozilla org mpl", 0.85),
    ("cc0-1.0", 0, "creativecommons org", r"creativecommons org publicdomain zero 1 0", 0.99),
    ("cc-by-only", 0, "creativecommons org", r"creativecommons org licenses by [0-9] [0-9]", 0.99),
    ("cc-by-sa", 0, "creativecommons org", r"creativecommons org licenses by sa [0-9] [0-9]", 0.99),
    ("cc-by-nc", 0, "creativecommons org", r"creativecommons org licenses by nc [0-9] [0-9]", 0.99),
    ("cc-by-nd", 0, "creativecommons org", r"creativecommons org licenses by nd [0-9] [0-9]", 0.99),
    ("cc-by-nc-sa", 0, "creativecommons org", r"creativecommons org licenses by nc sa [0-9] [0-9]", 0.99),
    ("cc-by-nc-nd", 0, "creativecommons org", r"creativecommons org licenses by nc nd [0-9] [0-9]", 0.99),
    ("boost", 1, "boost org", r"boost org license 1 0(?: txt)?", 0.95),
    ("unlicense", 0, "unencumbered software", r"this is free and unencumbered software released into the public domain", 1.0),
    ("unlicense", 1, "unlicense org", r"unlicense org", 0.9),
    ("zlib", 0, "provided as is without", r"provided as is without any express or implied warranty in no event will the authors", 0.95),
    ("openssl", 1, "openssl toolkit", r"software developed by the openssl project for use in the openssl toolkit", 0.95),
    ("public-domain", 1, "public domain", r"(?:dedicated|released|placed|committed) (?:in|to|into) the public domain", 0.9),
    ("public-domain", 2, "public domain", r"(?:is|are) in the public domain", 0.8),
    ("public-domain", 3, "public domain", r"public domain", 0.5),
    ("proprietary", 0, "proprietary", r"(?:confidential and proprietary|proprietary and confidential)", 0.9),
    ("proprietary", 1, "unauthorized copying", r"unauthorized copying of this file via any medium is strictly prohibited", 0.98),
    ("proprietary", 2, "without", r"may not be (?:reproduced|copied|distributed)(?: or (?:reproduced|copied|distributed|transmitted))? without (?:the )?(?:prior |express |written )*permission", 0.85),
    ("proprietary", 2, "no part of this", r"no part of this (?:publication|book|document|work|website) may be reproduced", 0.9),
    ("proprietary", 3, "trade secret", r"trade secrets?", 0.4),
    ("all-rights", 2, "all rights reserved", r"all rights reserved", 0.8),
    ("some-rights", 2, "some rights reserved", r"some rights reserved", 0.7),
    ("no-rights", 2, "no rights reserved", r"no rights reserved", 0.7),
    ("all-rights", 2, "alle rechte", r"alle rechte vorbehalten", 0.8),
    ("all-rights", 2, "tous droits", r"tous droits réservés", 0.8),
    ("all-rights", 2, "todos los derechos", r"todos los derechos reservados", 0.8),
    ("copyright", 3, "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?", 0.4),
    ("warranty-disclaimer", 3, "without warrant", r"without warrant(?:y|ies) (?:or conditions )?of any kind", 0.5),
    ("warranty-disclaimer", 3, "as is", r"provided (?:by the copyright holders and contributors )?as is", 0.4),
    ("warranty-disclaimer", 3, "merchantability", r"merchantability (?:and|or) fitness for a particular purpose", 0.5),
    ("liability-disclaimer", 3, "in no event", r"in no event shall (?:the )?[a-z ]{1,60}? be liable", 0.5),
    ("licence-mention", 3, "licen", r"see (?:the )?licen[cs]e(?: file| txt| md)? for (?:more )?(?:details|information)", 0.4),
    ("licence-mention", 3, "licen", r"licen[cs]ed under(?: the)?", 0.3),
    ("licence-mention", 3, "licen", r"released under the [a-z0-9]+ licen[cs]e", 0.35),
    ("non-commercial", 2, "commercial", r"(?:for )?non ?commercial (?:use|purposes)(?: only)?", 0.6),
    ("research-only", 2, "research", r"for (?:academic |scientific )?research (?:use|purposes) only", 0.7),
    ("educational-only", 2, "educational", r"for educational (?:use|purposes) only", 0.7),
]

GRANT = r"(?:licensed|licenced|released|distributed|published|available|provided|covered|shared) (?:under|by|with)(?: an?| the)?(?: terms of(?: an?| the)?| conditions of(?: the)?)? (?:%s)(?: or (?:any )?later(?: version)?| only| international| unported)?"


def build() -> list[Rule]:
    rows: list[tuple[str, int, str, str, float]] = []
    for label, keyword, identifier, name in FAMILIES:
        versioned = any(c.isdigit() for c in label)
        rows.append((label, 0, keyword, GRANT % name, 0.99 if versioned else 0.95))
        rows.append((label, 1 if versioned else 2, keyword, f"(?:the )?(?:{name})", 0.9 if versioned else 0.8))
        rows.append((label, 0, "spdx license identifier", f"spdx license identifier (?:{identifier})", 1.0))
    for label, short, long in COMMONS:
        for version in COMMONS_VERSIONS:
            tail = f" {version}(?: international| unported| generic)?(?: licen[cs]e)?"
            rows.append((label, 0, f"cc {short} {version}", GRANT % f"cc {short}{tail}", 0.99))
            rows.append((label, 1, f"cc {short} {version}", f"cc {short}{tail}", 0.9))
        rows.append((label, 0, "creative commons", GRANT % f"creative commons {long}(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?", 0.98))
        rows.append((label, 1, "creative commons", f"creative commons {long}(?: [1-4] [05])?", 0.9))
        rows.append((label, 2, f"cc {short}", f"cc {short}", 0.7))
        rows.append((label, 0, "spdx license identifier", f"spdx license identifier cc {short} [1-4] [05]", 1.0))
    rows += CLAUSES
    rows += TEXTS
    return [Rule(i, *r) for i, r in enumerate(rows)]


RULES = build()

#: Literals of which every match of a rule contains one: a text without any of them has no detection.
GATES = [
    "licen", " reserved ", " cc by ", " cc0 ", "openrail", "open rail", " creative commons ", "creativecommons", " copyright ", " permission ", " redistributions ", " endorse or ", " advertising materials ",
    " bsd ", " mit no attribution ", " mulan psl", " boost org ", " gnu org ", " mozilla org ", " free software foundation ", " openssl ", " public domain ", " proprietary ", " unauthorized copying ",
    " trade secret", " warrant", " merchantability ", " in no event ", " as is ", "commercial ", "use only ", "purposes only ", " no part of ", " associated documentation files ",
    " product includes software ", " this software ", " the software ", " x consortium ", " window system ", " good and not evil ", " buy me a beer ", " works is permitted ", " just do what the ", " source and binary forms ",
    " display the following ", " attribution notices ", " verbatim copies ", " classpath exception ", " copyrighted ", " object code ", " commons clause ", " by installing ", " permissions ",
    " alle rechte ", " tous droits ", " todos los derechos ", " software and ",
]
