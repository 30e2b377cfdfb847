"""Signature rules for licences: label, keyword, priority, score and pattern, in order.

The patterns are written for normalised text: lower-case words with one blank between them, everything else dropped, so
"Apache License, Version 2.0" reads "apache license version 2 0". A rule is tried only where its keyword occurs as a word.
Priority 1 is an explicit identifier, 2 a title or notice with its version, 3 characteristic wording, 4 a mention, 5 a link.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    priority: int
    score: float
    pattern: str


# Written by hand, licence by licence: (label, ((keyword, priority, pattern), ...)).
_BY_HAND: tuple[tuple[str, tuple[tuple[str, int, str], ...]], ...] = (
    ("mit", (
        ("mit", 2, r"(?:released|licensed|distributed|available|published) under (?:the )?(?:terms of the )?mit license"),
        ("permission", 3, r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
        ("substantial", 3, r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
        ("mit", 4, r"the mit licen[cs]e(?: mit)?"),
        ("mit", 4, r"mit licen[cs]ed?"),
        ("expat", 4, r"expat licen[cs]e"),
    )),
    ("mit-0", (
        ("attribution", 2, r"mit no attribution(?: licen[cs]e)?"),
        ("mit", 2, r"mit 0 licen[cs]e"),
    )),
    ("x11", (
        ("x11", 2, r"x11 licen[cs]e"),
        ("consortium", 3, r"except as contained in this notice the name of the x consortium shall not be used in advertising"),
    )),
    ("apache-2.0", (
        ("apache", 2, r"licensed under (?:the )?apache licen[cs]e(?: version| v)? 2(?: 0)?"),
        ("apache", 2, r"apache (?:software )?licen[cs]e(?: version| v)? 2(?: 0)?"),
        ("apache", 4, r"apache 2(?: 0)?(?: licen[cs]ed?)?"),
        ("asl", 4, r"asl 2(?: 0)?"),
        ("compliance", 3, r"you may not use this file except in compliance with the license"),
        ("basis", 3, r"distributed on an as is basis without warranties or conditions of any kind"),
        ("apache", 5, r"www apache org licenses license 2 0"),
    )),
    ("apache-1.1", (
        ("apache", 2, r"apache software licen[cs]e(?: version)? 1 1"),
        ("apache", 3, r"the names apache and apache software foundation must not be used to endorse"),
    )),
    ("apache-1.0", (
        ("apache", 2, r"apache (?:software )?licen[cs]e(?: version)? 1 0"),
    )),
    ("apache", (
        ("apache", 4, r"(?:the )?apache (?:software )?licen[cs]e"),
    )),
    ("gpl-2.0", (
        ("gnu", 2, r"gnu general public licen[cs]e(?: as published by the free software foundation)?(?: either)? (?:version|v) 2(?: 0)?(?: only)?"),
        ("gnu", 2, r"gnu gpl (?:version |v)?2(?: 0)?"),
        ("gplv2", 2, r"gplv2(?: 0)?"),
        ("gpl", 2, r"gpl (?:version |v )?2(?: 0)?(?: only)?"),
        ("gpl", 5, r"www gnu org licenses (?:old licenses )?gpl 2 0"),
    )),
    ("gpl-2.0-or-later", (
        ("gnu", 2, r"gnu general public licen[cs]e(?: as published by the free software foundation)? either version 2(?: of the license)? or at your option any later version"),
        ("gplv2", 2, r"gplv2(?: 0)? or later"),
        ("gpl", 2, r"gpl (?:version |v )?2(?: 0)? or (?:any )?later"),
    )),
    ("gpl-3.0", (
        ("gnu", 2, r"gnu general public licen[cs]e(?: as published by the free software foundation)?(?: either)? (?:version|v) 3(?: 0)?(?: only)?"),
        ("gnu", 2, r"gnu gpl (?:version |v)?3(?: 0)?"),
        ("gplv3", 2, r"gplv3(?: 0)?"),
        ("gpl", 2, r"gpl (?:version |v )?3(?: 0)?(?: only)?"),
        ("gpl", 5, r"www gnu org licenses gpl 3 0"),
    )),
    ("gpl-3.0-or-later", (
        ("gnu", 2, r"gnu general public licen[cs]e(?: as published by the free software foundation)? either version 3(?: of the license)? or at your option any later version"),
        ("gplv3", 2, r"gplv3(?: 0)? or later"),
        ("gpl", 2, r"gpl (?:version |v )?3(?: 0)? or (?:any )?later"),
    )),
    ("gpl-1.0", (
        ("gnu", 2, r"gnu general public licen[cs]e (?:version|v) 1(?: 0)?"),
    )),
    ("gpl", (
        ("redistribute", 3, r"you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
        ("general", 4, r"(?:gnu )?general public licen[cs]e"),
        ("gpl", 4, r"gnu gpl"),
        ("gpl", 4, r"gpl licen[cs]ed?"),
        ("gnu", 5, r"www gnu org (?:licenses|copyleft) gpl"),
    )),
    ("lgpl-2.0", (
        ("library", 2, r"gnu library general public licen[cs]e(?: version)? 2(?: 0)?"),
        ("lgpl", 2, r"lgpl (?:version |v )?2(?: 0)"),
    )),
    ("lgpl-2.1", (
        ("lesser", 2, r"gnu lesser general public licen[cs]e(?: as published by the free software foundation)?(?: either)? (?:version|v) 2 1"),
        ("lgpl", 2, r"lgpl (?:version |v )?2 1"),
        ("lgplv2", 2, r"lgplv2(?: 1)?"),
        ("gnu", 5, r"www gnu org licenses (?:old licenses )?lgpl 2 1"),
    )),
    ("lgpl-3.0", (
        ("lesser", 2, r"gnu lesser general public licen[cs]e(?: as published by the free software foundation)?(?: either)? (?:version|v) 3(?: 0)?"),
        ("lgpl", 2, r"lgpl (?:version |v )?3(?: 0)?"),
        ("lgplv3", 2, r"lgplv3"),
        ("gnu", 5, r"www gnu org licenses lgpl 3 0"),
    )),
    ("lgpl", (
        ("lesser", 4, r"(?:gnu )?lesser general public licen[cs]e"),
        ("library", 4, r"(?:gnu )?library general public licen[cs]e"),
        ("lgpl", 4, r"(?:gnu )?lgpl(?: licen[cs]ed?)?"),
    )),
    ("agpl-3.0", (
        ("affero", 2, r"gnu affero general public licen[cs]e(?: as published by the free software foundation)?(?: either)? (?:version|v) 3(?: 0)?"),
        ("agpl", 2, r"agpl (?:version |v )?3(?: 0)?"),
        ("agplv3", 2, r"agplv3"),
        ("gnu", 5, r"www gnu org licenses agpl 3 0"),
    )),
    ("agpl", (
        ("affero", 4, r"(?:gnu )?affero general public licen[cs]e"),
        ("agpl", 4, r"(?:gnu )?agpl(?: licen[cs]ed?)?"),
        ("interacting", 3, r"all users interacting with it remotely through a computer network"),
    )),
    ("gfdl", (
        ("documentation", 2, r"gnu free documentation licen[cs]e(?: version 1 [123])?"),
        ("gfdl", 4, r"gfdl"),
        ("invariant", 3, r"with no invariant sections no front cover texts and no back cover texts"),
    )),
    ("bsd-2-clause", (
        ("bsd", 2, r"(?:the )?bsd 2 clause(?: simplified)?(?: licen[cs]e)?"),
        ("bsd", 2, r"simplified bsd licen[cs]e"),
        ("freebsd", 2, r"freebsd licen[cs]e"),
        ("bsd", 2, r"2 clause bsd(?: licen[cs]e)?"),
    )),
    ("bsd-3-clause", (
        ("bsd", 2, r"(?:the )?bsd 3 clause(?: new)?(?: licen[cs]e)?"),
        ("bsd", 2, r"(?:new|revised|modified) bsd licen[cs]e"),
        ("bsd", 2, r"3 clause bsd(?: licen[cs]e)?"),
        ("endorse", 3, r"neither the name of .{1,80}? nor the names of its contributors may be used to endorse or promote products"),
    )),
    ("bsd-4-clause", (
        ("bsd", 2, r"(?:the )?bsd 4 clause(?: licen[cs]e)?"),
        ("bsd", 2, r"original bsd licen[cs]e"),
        ("advertising", 3, r"all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment"),
    )),
    ("bsd-0-clause", (
        ("0bsd", 2, r"0bsd"),
        ("bsd", 2, r"(?:zero|0) clause bsd(?: licen[cs]e)?"),
    )),
    ("bsd", (
        ("redistributions", 3, r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
        ("redistributions", 3, r"redistributions in binary form must reproduce the above copyright notice"),
        ("bsd", 4, r"bsd (?:style )?licen[cs]ed?"),
    )),
    ("isc", (
        ("isc", 2, r"(?:the )?isc licen[cs]e"),
        ("purpose", 3, r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    )),
    ("mpl-2.0", (
        ("mozilla", 2, r"mozilla public licen[cs]e(?: version| v)? 2(?: 0)?"),
        ("mpl", 2, r"mpl (?:version |v )?2(?: 0)?"),
        ("mozilla", 3, r"this source code form is subject to the terms of the mozilla public licen[cs]e"),
        ("mozilla", 5, r"mozilla org mpl 2 0"),
    )),
    ("mpl-1.1", (
        ("mozilla", 2, r"mozilla public licen[cs]e(?: version| v)? 1 1"),
        ("mpl", 2, r"mpl (?:version |v )?1 1"),
    )),
    ("mpl-1.0", (
        ("mozilla", 2, r"mozilla public licen[cs]e(?: version| v)? 1 0"),
    )),
    ("mpl", (
        ("mozilla", 4, r"mozilla public licen[cs]e"),
    )),
    ("epl-2.0", (
        ("eclipse", 2, r"eclipse public licen[cs]e(?: version| v)? 2(?: 0)?"),
        ("epl", 2, r"epl (?:version |v )?2(?: 0)?"),
        ("eclipse", 5, r"eclipse org legal epl (?:2 0|v20)"),
    )),
    ("epl-1.0", (
        ("eclipse", 2, r"eclipse public licen[cs]e(?: version| v)? 1(?: 0)?"),
        ("epl", 2, r"epl (?:version |v )?1(?: 0)?"),
        ("eclipse", 5, r"eclipse org legal epl v10"),
    )),
    ("epl", (
        ("eclipse", 4, r"eclipse public licen[cs]e"),
    )),
    ("edl-1.0", (
        ("eclipse", 2, r"eclipse distribution licen[cs]e"),
    )),
    ("cddl-1.0", (
        ("cddl", 2, r"cddl (?:version |v )?1 0"),
        ("distribution", 2, r"common development and distribution licen[cs]e(?: cddl)?(?: version| v)? 1 0"),
    )),
    ("cddl-1.1", (
        ("cddl", 2, r"cddl (?:version |v )?1 1"),
        ("distribution", 2, r"common development and distribution licen[cs]e(?: cddl)?(?: version| v)? 1 1"),
    )),
    ("cddl", (
        ("distribution", 4, r"common development and distribution licen[cs]e"),
        ("cddl", 4, r"cddl"),
    )),
    ("cpl-1.0", (
        ("common", 2, r"common public licen[cs]e(?: version| v)?(?: 1 0)?"),
    )),
    ("ipl-1.0", (
        ("ibm", 2, r"ibm public licen[cs]e"),
    )),
    ("artistic-2.0", (
        ("artistic", 2, r"artistic licen[cs]e(?: version| v)? 2(?: 0)?"),
    )),
    ("artistic-1.0", (
        ("artistic", 2, r"artistic licen[cs]e(?: version| v)? 1(?: 0)?"),
    )),
    ("artistic", (
        ("artistic", 4, r"artistic licen[cs]e"),
        ("perl", 4, r"under the same terms as perl itself"),
    )),
    ("zlib", (
        ("zlib", 2, r"zlib(?: libpng)? licen[cs]e"),
        ("misrepresented", 3, r"the origin of this software must not be misrepresented"),
        ("altered", 3, r"altered source versions must be plainly marked as such"),
    )),
    ("libpng", (
        ("libpng", 2, r"libpng licen[cs]e"),
    )),
    ("boost-1.0", (
        ("boost", 2, r"boost software licen[cs]e(?: version| v)?(?: 1 0)?"),
        ("bsl", 4, r"bsl 1 0"),
        ("boost", 5, r"www boost org license 1 0"),
    )),
    ("unlicense", (
        ("unlicense", 2, r"(?:the )?unlicense"),
        ("encumbered", 3, r"this is free and unencumbered software released into the public domain"),
        ("unencumbered", 3, r"free and unencumbered software released into the public domain"),
    )),
    ("wtfpl", (
        ("wtfpl", 2, r"wtfpl"),
        ("fuck", 2, r"do what the fuck you want to public licen[cs]e"),
    )),
    ("cc0-1.0", (
        ("cc0", 2, r"cc0(?: 1 0)?(?: universal)?"),
        ("creativecommons", 5, r"creativecommons org publicdomain zero 1 0"),
        ("waived", 3, r"has waived all copyright and related or neighboring rights"),
    )),
    ("cc-by-4.0", (
        ("cc", 2, r"cc by 4 0"),
        ("attribution", 2, r"creative commons attribution 4 0(?: international)?"),
        ("creativecommons", 5, r"creativecommons org licenses by 4 0"),
    )),
    ("cc-by-3.0", (
        ("cc", 2, r"cc by 3 0"),
        ("attribution", 2, r"creative commons attribution 3 0(?: unported)?"),
        ("creativecommons", 5, r"creativecommons org licenses by 3 0"),
    )),
    ("cc-by-sa-4.0", (
        ("cc", 2, r"cc by sa 4 0"),
        ("sharealike", 2, r"creative commons attribution sharealike 4 0(?: international)?"),
        ("creativecommons", 5, r"creativecommons org licenses by sa 4 0"),
    )),
    ("cc-by-sa-3.0", (
        ("cc", 2, r"cc by sa 3 0"),
        ("sharealike", 2, r"creative commons attribution sharealike 3 0(?: unported)?"),
        ("creativecommons", 5, r"creativecommons org licenses by sa 3 0"),
    )),
    ("cc-by-nc-4.0", (
        ("cc", 2, r"cc by nc 4 0"),
        ("noncommercial", 2, r"creative commons attribution noncommercial 4 0(?: international)?"),
        ("creativecommons", 5, r"creativecommons org licenses by nc 4 0"),
    )),
    ("cc-by-nc-sa-4.0", (
        ("cc", 2, r"cc by nc sa 4 0"),
        ("noncommercial", 2, r"creative commons attribution noncommercial sharealike 4 0(?: international)?"),
        ("creativecommons", 5, r"creativecommons org licenses by nc sa 4 0"),
    )),
    ("cc-by-nc-nd-4.0", (
        ("cc", 2, r"cc by nc nd 4 0"),
        ("noderivatives", 2, r"creative commons attribution noncommercial noderivatives 4 0(?: international)?"),
        ("creativecommons", 5, r"creativecommons org licenses by nc nd 4 0"),
    )),
    ("cc-by-nd-4.0", (
        ("cc", 2, r"cc by nd 4 0"),
        ("noderivatives", 2, r"creative commons attribution noderivatives 4 0(?: international)?"),
        ("creativecommons", 5, r"creativecommons org licenses by nd 4 0"),
    )),
    ("cc-by", (
        ("cc", 4, r"cc by"),
        ("creative", 4, r"creative commons attribution"),
    )),
    ("creative-commons", (
        ("creative", 4, r"creative commons(?: licen[cs]e)?"),
    )),
    ("public-domain", (
        ("domain", 4, r"(?:placed|released|dedicated|is) (?:in|into|to) the public domain"),
        ("domain", 4, r"public domain dedication"),
    )),
    ("python-2.0", (
        ("python", 2, r"python software foundation licen[cs]e(?: version 2)?"),
        ("psf", 4, r"psf licen[cs]e"),
    )),
    ("php-3.01", (
        ("php", 2, r"php licen[cs]e(?: version| v)?(?: 3 01?)?"),
    )),
    ("ruby", (
        ("ruby", 2, r"ruby licen[cs]e"),
    )),
    ("openssl", (
        ("openssl", 2, r"openssl licen[cs]e"),
        ("openssl", 3, r"this product includes software developed by the openssl project"),
    )),
    ("postgresql", (
        ("postgresql", 2, r"postgresql licen[cs]e"),
    )),
    ("ncsa", (
        ("ncsa", 2, r"(?:university of illinois )?ncsa open source licen[cs]e"),
    )),
    ("w3c", (
        ("w3c", 2, r"w3c software(?: notice and)? licen[cs]e"),
    )),
    ("ofl-1.1", (
        ("sil", 2, r"sil open font licen[cs]e(?: version| v)?(?: 1 1)?"),
        ("ofl", 4, r"ofl 1 1"),
        ("font", 4, r"open font licen[cs]e"),
    )),
    ("eupl-1.2", (
        ("european", 2, r"european union public licen[cs]e(?: version| v)?(?: 1 2)?"),
        ("eupl", 4, r"eupl"),
    )),
    ("ms-pl", (
        ("microsoft", 2, r"microsoft public licen[cs]e"),
        ("ms", 4, r"ms pl"),
    )),
    ("ms-rl", (
        ("microsoft", 2, r"microsoft reciprocal licen[cs]e"),
    )),
    ("osl-3.0", (
        ("open", 2, r"open software licen[cs]e(?: version| v)?(?: 3 0)?"),
    )),
    ("afl-3.0", (
        ("academic", 2, r"academic free licen[cs]e(?: version| v)?(?: 3 0)?"),
    )),
    ("ecl-2.0", (
        ("educational", 2, r"educational community licen[cs]e(?: version| v)?(?: 2 0)?"),
    )),
    ("upl-1.0", (
        ("universal", 2, r"universal permissive licen[cs]e(?: version| v)?(?: 1 0)?"),
    )),
    ("bsl-1.1", (
        ("business", 2, r"business source licen[cs]e(?: version| v)?(?: 1 1)?"),
    )),
    ("sspl-1.0", (
        ("server", 2, r"server side public licen[cs]e(?: version| v)?(?: 1)?"),
        ("sspl", 4, r"sspl"),
    )),
    ("elastic-2.0", (
        ("elastic", 2, r"elastic licen[cs]e(?: version| v)?(?: 2 0)?"),
    )),
    ("odbl-1.0", (
        ("database", 2, r"open database licen[cs]e"),
        ("odbl", 4, r"odbl"),
    )),
    ("odc-by-1.0", (
        ("odc", 2, r"odc attribution licen[cs]e"),
        ("commons", 2, r"open data commons attribution licen[cs]e"),
    )),
    ("pddl-1.0", (
        ("commons", 2, r"open data commons public domain dedication and licen[cs]e"),
    )),
    ("llama", (
        ("llama", 2, r"llama [23](?: [0-9])? community licen[cs]e"),
    )),
    ("openrail", (
        ("openrail", 2, r"(?:creativeml )?openrail(?: m)?(?: licen[cs]e)?"),
    )),
    ("vim", (
        ("vim", 2, r"vim licen[cs]e"),
    )),
    ("beerware", (
        ("beerware", 2, r"beerware(?: licen[cs]e)?"),
        ("beer", 3, r"you can buy me a beer in return"),
    )),
    ("unicode", (
        ("unicode", 2, r"unicode(?: data files and software)? licen[cs]e"),
    )),
    ("curl", (
        ("curl", 2, r"curl licen[cs]e"),
    )),
    ("proprietary", (
        ("rights", 4, r"all rights reserved"),
        ("proprietary", 4, r"proprietary and confidential"),
        ("confidential", 3, r"unauthori[sz]ed copying of this file via any medium is strictly prohibited"),
    )),
)

_SCORES = {1: 1.0, 2: 0.95, 3: 0.8, 4: 0.6, 5: 0.5}


def _identifier_rules() -> list[Rule]:
    """For every label the tag that names it: "SPDX-License-Identifier: <label>", in any file's comment."""
    labels = [label for label, _ in _BY_HAND]
    return [Rule(label, "spdx", 1, 1.0, "spdx license identifier " + label.replace(".", " ").replace("-", " ")) for label in labels]


def _classifier_rules() -> list[Rule]:
    """Declared licences of package files: "license: <label>" or "license = <label>"."""
    labels = [label for label, _ in _BY_HAND]
    return [Rule(label, "license", 4, 0.7, "(?<!the )license (?:expression )?" + label.replace(".", " ").replace("-", " ")) for label in labels]


def rules() -> list[Rule]:
    """All rules, the most telling priority first; within a priority in the order written."""
    by_hand = [Rule(label, keyword, priority, _SCORES[priority], pattern) for label, own in _BY_HAND for keyword, priority, pattern in own]
    return sorted(_identifier_rules() + by_hand + _classifier_rules(), key=lambda rule: rule.priority)
