"""Signature rules for licences, in order of priority.

A rule is a regular expression over lower-case words joined by single spaces. The
table names licences once; ``rules()`` builds the signatures of each: its identifier
tag, grants under its name, its name with a version, its name alone. Longer passages of
licence texts and general notices are written out. A rule is tried where its key word
stands, the longest word that every match holds.
"""

import re
from dataclasses import dataclass

# Label, names, short names, versions (label part: words). Names are expressions.
LICENSES: list[tuple[str, str, str, dict[str, str]]] = [
    ("mit", r"mit", r"expat|x11 mit", {}),
    ("mit-0", r"mit no attribution", r"mit 0", {}),
    ("x11", r"x11", r"x consortium", {}),
    ("isc", r"isc|internet systems consortium", r"isc style", {}),
    ("apache", r"apache(?: software)?", r"asl", {"1": r"1 0", "1.1": r"1 1", "2": r"2(?: 0)?"}),
    ("bsd", r"bsd|berkeley software distribution", r"bsd style", {}),
    ("bsd-2-clause", r"(?:2|two) clause bsd|simplified bsd|freebsd", r"bsd 2 clause", {}),
    ("bsd-3-clause", r"(?:3|three) clause bsd|(?:new|modified|revised) bsd", r"bsd 3 clause", {}),
    ("bsd-4-clause", r"(?:4|four) clause bsd|original bsd", r"bsd 4 clause", {}),
    ("0bsd", r"(?:zero|0) clause bsd", r"0bsd", {}),
    ("gpl", r"gnu general public", r"gnu gpl|gpl", {"1": r"1(?: 0)?", "2": r"2(?: 0)?", "3": r"3(?: 0)?"}),
    ("gpl", r"gnu gpl", r"gpl", {"2": r"2(?: 0)?|v2", "3": r"3(?: 0)?|v3"}),
    ("lgpl", r"gnu lesser general public", r"gnu lgpl", {"2.1": r"2 1", "3": r"3(?: 0)?"}),
    ("lgpl", r"gnu library general public", r"gnu library gpl", {"2": r"2(?: 0)?"}),
    ("lgpl", r"gnu lgpl", r"lgpl", {"2": r"2(?: 0)?", "2.1": r"2 1|v2 1", "3": r"3(?: 0)?|v3"}),
    ("agpl", r"gnu affero general public|affero general public", r"gnu agpl", {"1": r"1(?: 0)?", "3": r"3(?: 0)?"}),
    ("agpl", r"gnu agpl", r"agpl", {"3": r"3(?: 0)?|v3"}),
    ("gfdl", r"gnu free documentation", r"gfdl", {"1.1": r"1 1", "1.2": r"1 2", "1.3": r"1 3"}),
    ("mpl", r"mozilla public", r"mpl", {"1": r"1 0", "1.1": r"1 1", "2": r"2(?: 0)?"}),
    ("epl", r"eclipse public", r"epl", {"1": r"1 0", "2": r"2(?: 0)?"}),
    ("edl", r"eclipse distribution", r"edl", {"1": r"1 0"}),
    ("cddl", r"common development and distribution", r"cddl", {"1": r"1 0", "1.1": r"1 1"}),
    ("cpl", r"common public", r"cpl", {"1": r"1 0"}),
    ("ipl", r"ibm public", r"ipl", {"1": r"1 0"}),
    ("artistic", r"(?:perl )?artistic", r"perl artistic", {"1": r"1 0", "2": r"2(?: 0)?"}),
    ("bsl", r"boost software", r"bsl", {"1": r"1 0"}),
    ("zlib", r"zlib|zlib libpng", r"zlib style", {}),
    ("libpng", r"libpng", r"png reference library", {}),
    ("unlicense", r"unlicense|the unlicense", r"unlicense org", {}),
    ("wtfpl", r"do what the fuck you want to public", r"wtfpl", {"2": r"2"}),
    ("python", r"python software foundation", r"psf|psfl", {"2": r"2(?: 0)?"}),
    ("php", r"php", r"php style", {"3": r"3(?: 0)?", "3.01": r"3 01"}),
    ("ruby", r"ruby", r"ruby s", {}),
    ("openssl", r"openssl", r"openssl ssleay", {}),
    ("postgresql", r"postgresql", r"postgres", {}),
    ("ncsa", r"university of illinois ncsa(?: open source)?", r"ncsa", {}),
    ("ofl", r"sil open font", r"ofl", {"1": r"1 0", "1.1": r"1 1"}),
    ("eupl", r"european union public", r"eupl", {"1.1": r"1 1", "1.2": r"1 2"}),
    ("cecill", r"cecill(?: free software)?", r"cecill b|cecill c", {"1": r"1 0", "2": r"2(?: 0)?", "2.1": r"2 1"}),
    ("ms-pl", r"microsoft public", r"ms pl", {}),
    ("ms-rl", r"microsoft reciprocal", r"ms rl", {}),
    ("osl", r"open software", r"osl", {"2.1": r"2 1", "3": r"3 0"}),
    ("afl", r"academic free", r"afl", {"2.1": r"2 1", "3": r"3 0"}),
    ("upl", r"universal permissive", r"upl", {"1": r"1 0"}),
    ("odbl", r"open database|open data commons open database", r"odbl", {"1": r"1 0"}),
    ("odc-by", r"open data commons attribution", r"odc by", {"1": r"1 0"}),
    ("pddl", r"open data commons public domain dedication and", r"pddl", {"1": r"1 0"}),
    ("bsl-business", r"business source", r"busl", {"1.1": r"1 1"}),
    ("sspl", r"server side public", r"sspl", {"1": r"1(?: 0)?"}),
    ("elastic", r"elastic", r"elv2", {"2": r"2(?: 0)?"}),
    ("llama", r"llama(?: \d)? community", r"llama", {}),
    ("openrail", r"(?:bigscience |creativeml )?open rail(?: m)?", r"rail", {}),
    ("cc0", r"creative commons (?:cc0|zero)", r"cc0", {"1": r"1(?: 0)?"}),
    *[
        (f"cc-{code.replace(' ', '-')}", rf"creative commons {words}", rf"cc {code}", {v: rf"{v}(?: 0)?" for v in "1234"})
        for code, words in (
            ("by", "attribution"),
            ("by sa", "attribution share ?alike"),
            ("by nd", "attribution no ?deriv(?:ative)?s?"),
            ("by nc", "attribution non ?commercial"),
            ("by nc sa", "attribution non ?commercial share ?alike"),
            ("by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?"),
        )
    ],
]

# Label, expression: passages of licence texts. The wording of the licences.
TEXTS = [
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", r"the software is provided as is without warranty of any kind express or implied"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", r"neither the name of .{1,120}? may be used to endorse or promote products"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("apache-2", r"see the license for the specific language governing permissions and limitations under the license"),
    ("apache-2", r"you may not use this file except in compliance with the license"),
    ("apache-2", r"www apache org licenses license 2 0"),
    ("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", r"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("gpl-3", r"gnu org licenses gpl(?: 3 0)?(?: html| txt)?"),
    ("gpl", r"you should have received a copy of the gnu general public license"),
    ("lgpl", r"you should have received a copy of the gnu lesser general public license"),
    ("agpl-3", r"you should have received a copy of the gnu affero general public license"),
    ("mpl-2", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl", r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("bsl-1", r"distributed under the boost software license version 1 0"),
    ("zlib", r"altered source versions must be plainly marked as such"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", r"you just do what the fuck you want to"),
    ("cc0-1", r"to the extent possible under law .{1,120}? has waived all copyright"),
    ("cc-by-4", r"creativecommons org licenses by 4 0"),
    ("cc-by-sa-4", r"creativecommons org licenses by sa 4 0"),
    ("cc-by-nc-4", r"creativecommons org licenses by nc 4 0"),
    ("cc-by-nc-sa-4", r"creativecommons org licenses by nc sa 4 0"),
    ("cc-by-nc-nd-4", r"creativecommons org licenses by nc nd 4 0"),
    ("ofl-1.1", r"this font software is licensed under the sil open font license"),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", r"without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", r"warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders"),
    ("isc", r"provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc", r"the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("0bsd", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software"),
    ("bsd", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", r"this software is provided by the copyright holders and contributors as is and any express or implied warranties"),
    ("bsd-4-clause", r"this product includes software developed by the university of california berkeley and its contributors"),
    ("bsd-3-clause", r"neither the name of the copyright holder nor the names of its contributors may be used"),
    ("apache-2", r"licensed under the apache license version 2 0 the license"),
    ("apache-2", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2", r"licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-2", r"grant of copyright license subject to the terms and conditions of this license each contributor hereby grants"),
    ("apache-2", r"grant of patent license subject to the terms and conditions of this license each contributor hereby grants"),
    ("apache-1.1", r"this product includes software developed by the apache software foundation"),
    ("gpl", r"either version \d+ of the license or (?:at your option )?any later version"),
    ("gpl", r"without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"),
    ("gpl-2", r"as published by the free software foundation either version 2 of the license"),
    ("gpl-2", r"gnu general public license version 2 only as published by the free software foundation"),
    ("gpl-3", r"as published by the free software foundation either version 3 of the license"),
    ("gpl-3", r"the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl", r"the licenses for most software are designed to take away your freedom to share and change it"),
    ("lgpl-2.1", r"as published by the free software foundation either version 2 1 of the license"),
    ("lgpl", r"see the gnu lesser general public license for more details"),
    ("lgpl", r"this license the lesser general public license applies to some specially designated software packages"),
    ("agpl-3", r"the gnu affero general public license is a free copyleft license for software and other kinds of works"),
    ("agpl-3", r"if you modify the program your modified version must prominently offer all users interacting with it remotely"),
    ("agpl", r"see the gnu affero general public license for more details"),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("mpl-2", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-1.1", r"software distributed under the license is distributed on an as is basis without warranty of any kind either express or implied see the license"),
    ("epl-2", r"this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("epl", r"the accompanying program is provided under the terms of this eclipse public license"),
    ("edl-1", r"made available under the terms of the eclipse distribution license v 1 0"),
    ("cddl", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("cddl", r"when distributing covered code include this cddl header in each file"),
    ("cpl-1", r"the accompanying program is provided under the terms of this common public license"),
    ("ipl-1", r"the accompanying program is provided under the terms of this ibm public license"),
    ("artistic-2", r"the artistic license 2 0 copyright c 2000 2006 the perl foundation"),
    ("artistic", r"same terms as perl itself either perl version|under the same terms as the perl 5 programming language system"),
    ("bsl-1", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", r"permission is granted to anyone to use this software for any purpose including commercial applications"),
    ("libpng", r"the png reference library is supplied as is the contributing authors .{1,120}? disclaim all warranties"),
    ("unlicense", r"anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary"),
    ("wtfpl-2", r"everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed"),
    ("python-2", r"psf is making python available to licensee on an as is basis"),
    ("python-2", r"this license agreement is between the python software foundation psf and the individual or organization"),
    ("php-3.01", r"this source file is subject to version 3 01 of the php license"),
    ("ruby", r"you may make and give away verbatim copies of the source form of the software without restriction"),
    ("openssl", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("openssl", r"this product includes cryptographic software written by eric young"),
    ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("x11", r"except as contained in this notice the name of the x consortium shall not be used in advertising"),
    ("ncsa", r"neither the names of .{1,120}? nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("ofl-1.1", r"the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects"),
    ("eupl", r"licensed under the eupl version 1 \d or as soon they will be approved by the european commission"),
    ("cecill", r"this software is governed by the cecill(?: b| c)? license under french law"),
    ("ms-pl", r"this license governs use of the accompanying software if you use the software you accept this license"),
    ("osl", r"licensed under the open software license version"),
    ("afl", r"licensed under the academic free license version"),
    ("upl-1", r"subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software associated documentation"),
    ("odbl-1", r"this .{1,60}? is made available under the open database license"),
    ("odc-by-1", r"this .{1,60}? is made available under the open data commons attribution license"),
    ("pddl-1", r"this .{1,60}? is made available under the public domain dedication and license"),
    ("bsl-business-1.1", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("sspl-1", r"if you make the functionality of the program or a modified version available to third parties as a service"),
    ("elastic-2", r"you may not provide the software to third parties as a hosted or managed service"),
    ("llama", r"is licensed under the llama \d community license"),
    ("openrail", r"use based restrictions as referenced in paragraph 5 must be included as an enforceable provision"),
    ("cc0-1", r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc0-1", r"creativecommons org publicdomain zero 1 0"),
    ("cc-by-nd-4", r"creativecommons org licenses by nd 4 0"),
    ("cc-by-3", r"creativecommons org licenses by 3 0"),
    ("cc-by-sa-3", r"creativecommons org licenses by sa 3 0"),
    ("cc-by-nc-3", r"creativecommons org licenses by nc 3 0"),
    ("cc-by-2", r"creativecommons org licenses by 2 0"),
    ("cc-by-sa-2", r"creativecommons org licenses by sa 2 0"),
    ("gpl-2", r"www gnu org licenses (?:old licenses )?gpl 2 0"),
    ("lgpl-2.1", r"www gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("agpl-3", r"www gnu org licenses agpl 3 0"),
    ("mit", r"opensource org licen[sc]es mit(?: license)?(?: php)?"),
    ("bsd-3-clause", r"opensource org licen[sc]es bsd 3 clause"),
    ("bsd-2-clause", r"opensource org licen[sc]es bsd 2 clause"),
    ("isc", r"opensource org licen[sc]es isc(?: license)?"),
    ("mpl-2", r"(?:www )?mozilla org (?:en us )?mpl 2 0"),
    ("bsl-1", r"www boost org license 1 0"),
]

# Label, expression: notices that name no licence.
NOTICES = [
    ("all-rights-reserved", r"all rights reserved"),
    ("proprietary", r"proprietary and confidential"),
    ("proprietary", r"confidential and proprietary"),
    ("proprietary", r"unauthorized (?:copying|use|reproduction)(?: or distribution)? .{0,60}?is (?:strictly )?prohibited"),
    ("public-domain", r"(?:released|dedicated|placed) (?:in|into|to) the public domain"),
    ("non-commercial", r"for (?:personal and )?non commercial use only"),
    ("non-commercial", r"for (?:personal and )?noncommercial use only"),
    ("permission-required", r"may not be reproduced .{0,80}?without (?:the )?(?:prior )?(?:written )?permission"),
]

# Words one of which stands near every place that a rule can match.
TRIGGERS = (
    "license licence licensed licenced licenses licences licensing spdx copyright copyrighted reserved"
    " permission granted redistribution redistribute warranty merchantability acknowledgement governing"
    " compliance gpl lgpl agpl gfdl wtfpl cc0 unlicense unencumbered creativecommons cc commons proprietary"
    " prohibited domain commercial noncommercial fuck mozilla gnu altered endorse creative"
    " mpl epl eupl cddl osl afl ofl cecill odbl upl disclaimer warranties sublicense perl liable conditions"
    " copies covered reproduce restriction includes version accept enforceable provision dedicated"
    " stimulate interacting functionality hosted anyone disclaims licensee consortium"
).split()

# Short names that stand for their licence with a version alone.
BARE = {"gpl", "gnu gpl", "lgpl", "gnu lgpl", "agpl", "gnu agpl", "gfdl", "mpl", "epl", "eupl", "cddl", "osl", "afl", "ofl", "odbl", "upl", "cc0"}

# Priority of each kind and its score.
TEXT, TAG, GRANT, VERSION, NAME, NOTICE = range(6)
SCORES = {TEXT: 1.0, TAG: 1.0, GRANT: 0.95, VERSION: 0.9, NAME: 0.7, NOTICE: 0.5}

# Forms of a grant; each holds the word licence or license.
_UNDER = r"(?:under|by|subject to)(?: the| a| an)?(?: terms of(?: the)?)?"
_LICENSED = rf"licen[sc]ed {_UNDER}"
_GIVEN = rf"(?:released|distributed|available|published|provided|shared|covered|offered) {_UNDER}"
_LICENSE = r"(?: public)? licen[sc]e"
_VERSION = r"(?: version| v| ver)?"
# The bar between two names, not one inside a group.
_EITHER = r"\|(?![^(]*\))"


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    key: str
    expression: re.Pattern  # over words with a space before and behind each
    needed: frozenset[str]
    reach: int  # words that a match spans at most


def required(expression: str) -> list[str]:
    """Words that every match of an expression holds."""
    text = expression.replace("licen[sc]e", "license")
    while (group := re.search(r"\(\?:([^()]*)\)\??", text)) is not None:
        apart = all(part[:1] == " " or part[-1:] == " " for part in group[1].split("|"))
        text = text[: group.start()] + (" " if apart else "\0") + text[group.end() :]
    text = re.sub(r"\w+ \?\w+", "\0", text)
    return [w for w in text.split() if re.fullmatch("[a-z0-9]+", w)]


def _rule(priority: int, label: str, expression: str) -> Rule:
    needed = [w for w in required(expression) if not w.startswith("licen")]
    # Every word but the first has a space before it, those inside a gap too.
    gaps = sum(int(n) for n in re.findall(r"\.\{\d+,(\d+)\}", expression))
    reach = expression.count(" ") + 1 + gaps // 2 + (1 if gaps else 0)
    return Rule(priority, label, max(needed, key=len), re.compile(rf" (?:{expression})(?= )"), frozenset(needed), reach)


def rules() -> list[Rule]:
    """All rules, the strongest kind first and versions before the bare licence; of equal
    expressions the first counts."""
    out = [_rule(TEXT, label, e) for label, e in TEXTS]
    for label, names, short, versions in LICENSES:
        for name in re.split(_EITHER, f"{names}|{short}"):
            for version, v in versions.items():
                own, v = f"{label}-{version}", f"(?:{v})"
                later = r"(?: only| or later)?"
                out.append(_rule(TAG, own, rf"spdx license identifier {name} {v}{later}"))
                out.append(_rule(TAG, own, rf"licen[sc]e {name}{_VERSION} {v}{later}"))
                out.append(_rule(GRANT, own, rf"{_LICENSED} {name}(?:{_LICENSE})?{_VERSION} {v}"))
                out.append(_rule(GRANT, own, rf"{_GIVEN} {name}{_LICENSE}{_VERSION} {v}"))
                out.append(_rule(GRANT, own, rf"under(?: the| a| an)? {name}{_VERSION} {v}{later}{_LICENSE}"))
                out.append(_rule(VERSION, own, rf"{name}{_LICENSE}{_VERSION} {v}"))
                if name in BARE or name.startswith("cc "):
                    out.append(_rule(VERSION, own, rf"{name}{_VERSION} {v}{later}"))
            out.append(_rule(TAG, label, rf"spdx license identifier {name}"))
            out.append(_rule(TAG, label, rf"licen[sc]e {name}"))
            out.append(_rule(GRANT, label, rf"{_LICENSED} {name}(?:{_LICENSE})?"))
            out.append(_rule(GRANT, label, rf"{_GIVEN} {name}{_LICENSE}"))
            out.append(_rule(NAME, label, rf"{name}{_LICENSE}"))
    out += [_rule(NOTICE, label, e) for label, e in NOTICES]
    first: dict[str, Rule] = {}
    for rule in sorted(out, key=lambda r: r.priority):
        first.setdefault(rule.expression.pattern, rule)
    return list(first.values())
