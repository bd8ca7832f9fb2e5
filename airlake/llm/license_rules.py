"""Signature rules for licences, written for texts reduced to lower-case words with single spaces between them.

Three tables of hand-written patterns: what a licence is called, what its text says, and general notices. A name gives three
rules (an identifier tag, a grant and a mention), a text clause or notice gives one. Shorthands in the patterns: ``~`` is
license or licence, singular or plural; ``@2.1`` is a version in its usual spellings (``@3`` also 3.0); ``_`` is a gap of up to three words.
Before the pattern stand the words that every match has: the prefilter. ``a+b|c`` asks for a, and for b or c.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

TAG, CLAUSE, GRANT, NAME, HINT = 5, 4, 3, 2, 1
CONFIDENCE = {TAG: 1.0, CLAUSE: 0.95, GRANT: 0.9, NAME: 0.6, HINT: 0.3}

#: label; words that must occur; what the licence is called
NAMES = """
mit; mit+license|licence|licenses|licences|expat; (?:the )?(?:mit ~|mit expat ~|mit x11 ~|expat ~)
mit-0; mit+0|attribution; mit 0 ~|mit no attribution(?: ~)?
x11; x11+license|licence; (?:the )?x11 ~
isc; isc+license|licence; (?:the )?isc ~
0bsd; bsd|0bsd+zero|0|0bsd; (?:bsd zero clause ~|zero clause bsd(?: ~)?|0bsd(?: ~)?|free public ~ @1)
bsd-1; bsd+1|one; (?:the )?(?:bsd 1 clause|1 clause bsd|one clause bsd)(?: ~)?
bsd-2; bsd+2|two|simplified|freebsd; (?:the )?(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)(?: ~)?
bsd-3; bsd+3|three|new|modified|revised; (?:the )?(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: ~)?
bsd-4; bsd+4|four|original; (?:the )?(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)(?: ~)?
bsd; bsd+license|licence|licenses|style; (?:the |a )?bsd(?: style)? ~
apache-1; apache+1; (?:the )?apache(?: software)? ~ @1
apache-1.1; apache+1; (?:the )?apache(?: software)? ~ @1.1
apache-2; apache|asl; (?:the )?(?:apache(?: software)? ~ @2|apache @2(?: ~)?|asl @2)
apache; apache+license|licence; (?:the |an )?apache(?: software)? ~
gpl-1; gpl|gnu; (?:the )?(?:gnu )?(?:gpl|general public ~) @1
gpl-2; gpl|gnu; (?:the )?(?:gnu )?(?:gpl|general public ~) @2
gpl-2+; gpl|gnu+later|newer; (?:the )?(?:gnu )?(?:gpl|general public ~) @2(?: of the ~)? or (?:at your option )?(?:any )?(?:later|newer)(?: version)?
gpl-3; gpl|gnu; (?:the )?(?:gnu )?(?:gpl|general public ~) @3
gpl-3+; gpl|gnu+later|newer; (?:the )?(?:gnu )?(?:gpl|general public ~) @3(?: of the ~)? or (?:at your option )?(?:any )?(?:later|newer)(?: version)?
gpl; gpl|gnu; (?:the )?(?:gnu gpl|gnu general public ~|gpl ~)
lgpl-2; lgpl|library; (?:the )?(?:gnu )?(?:lgpl|library general public ~) @2
lgpl-2.1; lgpl|lesser; (?:the )?(?:gnu )?(?:lgpl|lesser general public ~) @2.1
lgpl-2.1+; lgpl|lesser+later; (?:the )?(?:gnu )?(?:lgpl|lesser general public ~) @2.1(?: of the ~)? or (?:at your option )?(?:any )?later(?: version)?
lgpl-3; lgpl|lesser; (?:the )?(?:gnu )?(?:lgpl|lesser general public ~) @3
lgpl-3+; lgpl|lesser+later; (?:the )?(?:gnu )?(?:lgpl|lesser general public ~) @3(?: of the ~)? or (?:at your option )?(?:any )?later(?: version)?
lgpl; lgpl|lesser|library; (?:the )?(?:gnu )?(?:lgpl|lesser general public ~|library general public ~)
agpl-1; agpl|affero; (?:the )?(?:gnu )?(?:agpl|affero general public ~) @1
agpl-3; agpl|affero; (?:the )?(?:gnu )?(?:agpl|affero general public ~) @3
agpl-3+; agpl|affero+later; (?:the )?(?:gnu )?(?:agpl|affero general public ~) @3(?: of the ~)? or (?:at your option )?(?:any )?later(?: version)?
agpl; agpl|affero; (?:the )?(?:gnu )?(?:agpl|affero general public ~)
gfdl-1.1; gfdl|documentation; (?:the )?(?:gnu )?(?:gfdl|fdl|free documentation ~) @1.1
gfdl-1.2; gfdl|documentation; (?:the )?(?:gnu )?(?:gfdl|fdl|free documentation ~) @1.2
gfdl-1.3; gfdl|documentation; (?:the )?(?:gnu )?(?:gfdl|fdl|free documentation ~) @1.3
gfdl; gfdl|documentation; (?:the )?(?:gfdl|gnu free documentation ~)
mpl-1; mpl|mozilla; (?:the )?(?:mpl|mozilla public ~) @1
mpl-1.1; mpl|mozilla; (?:the )?(?:mpl|mozilla public ~) @1.1
mpl-2; mpl|mozilla; (?:the )?(?:mpl|mozilla public ~) @2
mpl; mozilla; (?:the )?mozilla public ~
epl-1; epl|eclipse; (?:the )?(?:epl|eclipse public ~) @1
epl-2; epl|eclipse; (?:the )?(?:epl|eclipse public ~) @2
epl; eclipse; (?:the )?eclipse public ~
edl-1; edl|eclipse; (?:the )?(?:edl|eclipse distribution ~) @1
cddl-1; cddl|distribution; (?:the )?(?:cddl|common development and distribution ~) @1
cddl-1.1; cddl|distribution; (?:the )?(?:cddl|common development and distribution ~) @1.1
cddl; cddl|development; (?:the )?(?:cddl(?: ~)?|common development and distribution ~)
cpl-1; cpl|common; (?:the )?(?:cpl|common public ~) @1
cpal-1; cpal|attribution; (?:the )?(?:cpal|common public attribution ~) @1
ipl-1; ibm; (?:the )?ibm public ~(?: @1)?
eupl-1.1; eupl|european; (?:the )?(?:eupl|european union public ~) @1.1
eupl-1.2; eupl|european; (?:the )?(?:eupl|european union public ~) @1.2
eupl; eupl|european; (?:the )?(?:eupl|european union public ~)
osl-3; osl|open; (?:the )?(?:osl|open software ~) @3
afl-3; afl|academic; (?:the )?(?:afl|academic free ~) @3
afl-2.1; afl|academic; (?:the )?(?:afl|academic free ~) @2.1
artistic-1; artistic; (?:the )?artistic ~ @1
artistic-2; artistic; (?:the )?artistic ~ @2
artistic; artistic+license|licence; (?:the )?artistic ~
perl; perl+terms|license|licence; (?:under )?(?:the )?same terms as perl(?: itself)?|the perl ~
bsl-1; boost; (?:the )?boost software ~(?: @1)?
busl-1.1; business|bsl|busl; (?:the )?business source ~(?: @1.1)?|busl @1.1
sspl-1; sspl|server; (?:the )?(?:sspl|server side public ~)(?: @1)?
elastic-2; elastic+license|licence; (?:the )?elastic ~(?: @2)?
polyform-noncommercial; polyform; (?:the )?polyform noncommercial ~(?: @1)?
polyform-strict; polyform; (?:the )?polyform strict ~(?: @1)?
polyform-small-business; polyform; (?:the )?polyform small business ~(?: @1)?
commons-clause; commons+clause; (?:the )?commons clause(?: ~)?
fsl; functional; (?:the )?functional source ~
confluent; confluent; (?:the )?confluent community ~
redis-sal; redis; (?:the )?redis source available ~
unlicense; unlicense; (?:the )?unlicense
wtfpl; wtfpl|fuck; wtfpl|do what the fuck you want to public ~
zlib; zlib; (?:the )?zlib(?: libpng)? ~
libpng; libpng; (?:the )?libpng ~
bzip2; bzip2; (?:the )?bzip2 ~
curl; curl+license|licence; (?:the )?curl ~
openssl; openssl; (?:the )?openssl ~
ssleay; ssleay; (?:the )?(?:original )?ssleay ~
openldap; openldap; (?:the )?openldap public ~(?: @2.8)?
psf-2; psf|python; (?:the )?(?:psf ~|python software foundation ~)(?: @2)?
python-2; python+license|licence; (?:the )?python ~ @2
php-3; php; (?:the )?php ~(?: @3)?
php-3.01; php; (?:the )?php ~ @3.01
ruby; ruby; (?:the )?ruby(?: s)? ~
postgresql; postgresql; (?:the )?postgresql ~
sqlite-blessing; sqlite|blessing; (?:the )?sqlite blessing
tcl; tcl; (?:the )?tcl(?: tk)? ~
vim; vim; (?:the )?vim ~
w3c; w3c; (?:the )?w3c(?: software)?(?: notice)?(?: and)? ~
icu; icu; (?:the )?icu ~
unicode-dfs; unicode; (?:the )?unicode(?: data files)?(?: and software)?(?: inc)? ~
ncsa; ncsa|illinois; (?:the )?(?:ncsa(?: open source)? ~|university of illinois open source ~)
ecl-2; educational|ecl; (?:the )?educational community ~(?: @2)?|ecl @2
upl-1; universal|upl; (?:the )?universal permissive ~(?: @1)?
ms-pl; microsoft; (?:the )?microsoft public ~|ms pl
ms-rl; microsoft; (?:the )?microsoft reciprocal ~|ms rl
mulan-2; mulan; (?:the )?mulan(?: permissive software)? ~(?: @2)?
cecill-2.1; cecill; (?:the )?cecill(?: free software)?(?: ~)?(?: agreement)?(?: @2.1)?
cecill-b; cecill; (?:the )?cecill b(?: ~)?
cecill-c; cecill; (?:the )?cecill c(?: ~)?
apsl-2; apple; (?:the )?apple public source ~(?: @2)?
qpl-1; q; (?:the )?q public ~(?: @1)?
sleepycat; sleepycat; (?:the )?sleepycat ~
spl-1; sun; (?:the )?sun public ~(?: @1)?
sissl; sun; (?:the )?sun industry standards source ~
npl-1.1; netscape; (?:the )?netscape public ~(?: @1.1)?
rpl-1.5; reciprocal; (?:the )?reciprocal public ~(?: @1.5)?
nasa-1.3; nasa; (?:the )?nasa open source agreement(?: @1.3)?
intel; intel; (?:the )?intel open source ~
lppl-1.3c; lppl|latex; (?:the )?(?:lppl|latex project public ~)(?: @1.3)?
ofl-1.1; ofl|font; (?:the )?(?:sil )?(?:ofl|open font ~)(?: @1.1)?
ubuntu-font; ubuntu; (?:the )?ubuntu font ~(?: @1)?
hpnd; historical; (?:the )?historical permission notice(?: and disclaimer)?
beerware; beer|beerware; (?:the )?(?:beer ware|beerware) ~
json; json+license|licence; (?:the )?json ~
opl-1; open+publication; (?:the )?open publication ~(?: @1)?
fal-1.3; art; (?:the )?(?:free art ~|licence art libre)(?: @1.3)?
odbl-1; odbl|database; (?:the )?(?:odbl|open database ~)(?: @1)?
odc-by-1; odc|commons; (?:the )?(?:odc by|open data commons attribution ~)(?: @1)?
pddl-1; pddl|domain; (?:the )?(?:pddl|public domain dedication and ~)(?: @1)?
cdla-permissive-2; cdla|community; (?:the )?(?:cdla permissive|community data ~ agreement permissive)(?: @2)?
cdla-sharing-1; cdla|community; (?:the )?(?:cdla sharing|community data ~ agreement sharing)(?: @1)?
ogl-uk-3; government; (?:the )?open government ~(?: @3)?
dl-de-by-2; datenlizenz; (?:die )?datenlizenz deutschland namensnennung(?: @2)?
etalab-2; etalab|ouverte; (?:la )?licence ouverte(?: etalab)?(?: @2)?
openrail; openrail|responsible; (?:the )?(?:creativeml |bigscience )?(?:open ?rail m?|responsible ai ~)(?: ~)?
llama-2; llama; (?:the )?llama 2 community ~(?: agreement)?
llama-3; llama; (?:the )?(?:meta )?llama 3(?: [12])? community ~(?: agreement)?
gemma; gemma; (?:the )?gemma(?: terms of use| ~)
cc0-1; cc0|zero; (?:the )?(?:cc0|creative commons zero)(?: @1)?(?: universal)?
cc-pdm-1; commons+mark; (?:the )?(?:creative commons )?public domain mark(?: @1)?
cc-by-2; cc|creative; (?:the )?(?:cc by|creative commons attribution)(?: ~)? @2
cc-by-2.5; cc|creative; (?:the )?(?:cc by|creative commons attribution)(?: ~)? @2.5
cc-by-3; cc|creative; (?:the )?(?:cc by|creative commons attribution)(?: ~)? @3
cc-by-4; cc|creative; (?:the )?(?:cc by|creative commons attribution)(?: ~)? @4
cc-by; cc|creative; (?:the |a )?(?:cc by|creative commons attribution)(?: ~)?
cc-by-sa-2; cc|creative; (?:the )?(?:cc by sa|creative commons attribution share ?alike)(?: ~)? @2
cc-by-sa-2.5; cc|creative; (?:the )?(?:cc by sa|creative commons attribution share ?alike)(?: ~)? @2.5
cc-by-sa-3; cc|creative; (?:the )?(?:cc by sa|creative commons attribution share ?alike)(?: ~)? @3
cc-by-sa-4; cc|creative; (?:the )?(?:cc by sa|creative commons attribution share ?alike)(?: ~)? @4
cc-by-sa; cc|creative; (?:the |a )?(?:cc by sa|creative commons attribution share ?alike)(?: ~)?
cc-by-nd-3; cc|creative; (?:the )?(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s?(?: works)?)(?: ~)? @3
cc-by-nd-4; cc|creative; (?:the )?(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s?(?: works)?)(?: ~)? @4
cc-by-nd; cc|creative; (?:the |a )?(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s?(?: works)?)(?: ~)?
cc-by-nc-2; cc|creative; (?:the )?(?:cc by nc|creative commons attribution non ?commercial)(?: ~)? @2
cc-by-nc-3; cc|creative; (?:the )?(?:cc by nc|creative commons attribution non ?commercial)(?: ~)? @3
cc-by-nc-4; cc|creative; (?:the )?(?:cc by nc|creative commons attribution non ?commercial)(?: ~)? @4
cc-by-nc; cc|creative; (?:the |a )?(?:cc by nc|creative commons attribution non ?commercial)(?: ~)?
cc-by-nc-sa-3; cc|creative; (?:the )?(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: ~)? @3
cc-by-nc-sa-4; cc|creative; (?:the )?(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: ~)? @4
cc-by-nc-sa; cc|creative; (?:the |a )?(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: ~)?
cc-by-nc-nd-3; cc|creative; (?:the )?(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?)(?: ~)? @3
cc-by-nc-nd-4; cc|creative; (?:the )?(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?)(?: ~)? @4
cc-by-nc-nd; cc|creative; (?:the |a )?(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?)(?: ~)?
cc; creative+commons; (?:the |a )?creative commons(?: public)? ~
"""

#: label; words that must occur; words of the licence's own text or of its standard notice
CLAUSES = """
mit; hereby+granted; permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit; substantial+portions; (?:the )?above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software
isc; purpose+hereby; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that
0bsd; purpose+hereby; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted(?= the software)
bsd-2; redistributions; redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution(?= this software)
bsd-3; endorse; neither the name of _ nor the names of its contributors may be used to endorse or promote products derived from this software
bsd-4; advertising; all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd; redistribution+binary; redistribution and use in source and binary forms with or without modification are permitted
apache-2; apache; licensed under the apache ~ @2 the ~ you may not use this file except in compliance with the ~
apache-2; apache; (?:you may obtain a copy of the ~ at )?(?:http|https) www apache org ~ ~ 2 0
apache-1.1; apache; this product includes software developed by the apache software foundation
gpl-1+; gpl|gnu; free software you can redistribute it and or modify it under the terms of the gnu general public ~ as published by the free software foundation either @1 or
gpl-2+; gnu; free software you can redistribute it and or modify it under the terms of the gnu general public ~ as published by the free software foundation either @2(?: of the ~)? or at your option any later version
gpl-3+; gnu; free software you can redistribute it and or modify it under the terms of the gnu general public ~ as published by the free software foundation either @3(?: of the ~)? or at your option any later version
gpl-2; gnu+free; terms of the gnu general public ~ @2(?: only)? as published by the free software foundation
gpl-3; work+gnu; this work is licensed under the gnu general public ~ @3
lgpl-2.1+; lesser; terms of the gnu lesser general public ~ as published by the free software foundation either @2.1(?: of the ~)? or at your option any later version
lgpl-3+; lesser; terms of the gnu lesser general public ~ as published by the free software foundation either @3(?: of the ~)? or at your option any later version
agpl-3+; affero; terms of the gnu affero general public ~ as published by the free software foundation either @3(?: of the ~)? or at your option any later version
gpl; gnu+copy; you should have received a copy of the gnu general public ~(?: along with)?
lgpl; lesser+copy; you should have received a copy of the gnu lesser general public ~(?: along with)?
agpl; affero+copy; you should have received a copy of the gnu affero general public ~(?: along with)?
gpl-classpath; classpath|exception; as a special exception the copyright holders of this library give you permission to link this library with independent modules
gfdl; invariant; permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation ~
mpl-2; mozilla; this source code form is subject to the terms of the mozilla public ~(?: v)? @2
mpl-2; mozilla; if a copy of the mpl was not distributed with this file you can obtain one at
mpl-1.1; mozilla|mpl; the contents of this file are subject to the mozilla public ~ @1.1
epl-1; eclipse; are made available under the terms of the eclipse public ~ v ?1 0
epl-2; eclipse; are made available under the terms of the eclipse public ~ v ?2 0
cddl; cddl|distribution; the contents of this file are subject to the terms of the common development and distribution ~
unlicense; unencumbered; this is free and unencumbered software released into the public domain
unlicense; compile; anyone is free to copy modify publish use compile sell or distribute this software
wtfpl; fuck; you just do what the fuck you want to
zlib; altered; altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib; implied+arising; this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software
bsl-1; boost; distributed under the boost software ~ @1
bsl-1; obtaining+machine; unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor
json; evil; the software shall be used for good not evil
beerware; beer; you can buy me a beer in return
ofl-1.1; font; this font software is licensed under the sil open font ~ @1.1
artistic-2; artistic; everyone is permitted to copy and distribute verbatim copies of this ~ document
sqlite-blessing; blessing; may you do good and not evil
psf-2; python; psf hereby grants licensee a nonexclusive royalty free world wide ~
openssl; openssl; this product includes software developed by the openssl project for use in the openssl toolkit
ssleay; eric; this product includes cryptographic software written by eric young
curl; copyright+fee; permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
hpnd; supporting; in supporting documentation and that the name of _ not be used in advertising
cc0-1; dedicated; (?:has )?dedicated the work to the public domain by waiving all of his or her rights
cc-by; creative+work; this work is licensed under a creative commons attribution(?: \\d)?
cc-by-sa; share|sharealike; if you remix transform or build upon the material you must distribute your contributions under the same ~
cc-by-nd; remix; if you remix transform or build upon the material you may not distribute the modified material
cc-by-nc; commercial; you may not use the material for commercial purposes
cc-by-4; creativecommons+by; creativecommons org ~ by 4 0
cc-by-sa-4; creativecommons+sa; creativecommons org ~ by sa 4 0
cc-by-nc-4; creativecommons+nc; creativecommons org ~ by nc 4 0
cc-by-nd-4; creativecommons+nd; creativecommons org ~ by nd 4 0
cc-by-nc-sa-4; creativecommons+nc; creativecommons org ~ by nc sa 4 0
cc-by-nc-nd-4; creativecommons+nc; creativecommons org ~ by nc nd 4 0
cc-by-3; creativecommons+by; creativecommons org ~ by 3 0
cc-by-sa-3; creativecommons+sa; creativecommons org ~ by sa 3 0
cc0-1; creativecommons+zero; creativecommons org publicdomain zero 1 0
cc-pdm-1; creativecommons+mark; creativecommons org publicdomain mark 1 0
ogl-uk-3; government; contains public sector information licensed under the open government ~
"""

#: label; words that must occur; notices that name no licence
NOTICES = """
public-domain; public+domain; (?:released|placed|dedicated|put) (?:in|into|to) the public domain
public-domain; public+domain; (?:this|the) (?:work|file|text|book|document|software|code) is in the public domain
proprietary; proprietary+confidential; proprietary and confidential|confidential and proprietary
proprietary; unauthorized|unauthorised; unauthori[sz]ed (?:copying|use|reproduction|distribution) _ (?:is )?(?:strictly )?prohibited
proprietary; reproduced+permission; (?:may not|no part _ may) be reproduced _ without (?:the )?(?:prior )?(?:written )?permission
proprietary; commercial+license|licence; (?:a |the )?commercial ~ (?:is required|agreement)
all-rights-reserved; rights+reserved; all rights reserved
all-rights-reserved; rechte+vorbehalten; alle rechte vorbehalten
all-rights-reserved; droits+réservés; tous droits réservés
all-rights-reserved; derechos+reservados; todos los derechos reservados
non-commercial; non|noncommercial; for (?:personal and )?non ?commercial use only
research-only; research; for (?:academic |non commercial )?research (?:use|purposes) only
free-use; permission; permission is granted to (?:freely )?(?:copy|use|reproduce|distribute)(?: [a-z]+){0,6} for any purpose
dual; dual+license|licensed|licence; dual(?:ly)? licensed under|dual ~
see-license; license|licence+file; see (?:the )?~ file(?: for details)?
copyleft; copyleft; copyleft
"""

#: Identifiers of tags that differ from the label with its version completed.
TAGS = {"apache-2": "apache 2 0", "mit-0": "mit 0", "bsl-1": "bsl 1 0", "unlicense": "unlicense"}


@dataclass(frozen=True)
class Rule:
    label: str
    needs: tuple[frozenset[bytes], ...]  # every group has a word in the text
    priority: int
    confidence: float
    pattern: re.Pattern[bytes]


def expand(pattern: str) -> str:
    """The shorthands written out."""
    pattern = pattern.replace("~", "licen[cs]es?").replace(" _ ", "(?: [^ ]+){0,3}? ")
    version = lambda m: rf"(?:version |v )?v?{m[1]}" + (f" {m[2]}" if m[2] else "(?: 0)?")
    return re.sub(r"@(\d+)(?:\.(\d+))?", version, pattern)


def _rule(label: str, needs: str, priority: int, body: str) -> Rule:
    groups = tuple(frozenset(w.encode() for w in g.split("|")) for g in needs.split("+"))
    # texts have a space at each end, so a leading space and one ahead hold the word borders
    return Rule(label, groups, priority, CONFIDENCE[priority], re.compile(f" (?:{body})(?= )".encode()))


def _tag(label: str) -> str:
    """How an identifier tag spells a label: its parts, the version with or without a final zero, only or or later."""
    if label in TAGS:
        return TAGS[label]
    later, plain = label.endswith("+"), label.rstrip("+")
    words = re.sub(r"[-.]", " ", plain)
    if re.search(r" \d+$", words) and "." not in plain:
        words += "(?: 0)?"
    return words + (" or later" if later else "(?: only)?")


def _table(text: str) -> list[list[str]]:
    return [[part.strip() for part in line.split(";", 2)] for line in text.strip().splitlines()]


def rules() -> list[Rule]:
    """All rules in order; of equal detections the earlier rule stands."""
    out = []
    for label, needs, body in _table(CLAUSES):
        out.append(_rule(label, needs, CLAUSE, expand(body)))
    for label, needs, body in _table(NAMES):
        name = f"(?:{expand(body)})"
        out.append(_rule(label, "spdx", TAG, rf"spdx license identifier {_tag(label)}"))
        verbs = "licensed|released|distributed|published|available|provided|offered|covered|governed|redistribute"
        out.append(_rule(label, needs, GRANT, rf"(?:{verbs})(?: [^ ]+){{0,3}}? (?:under|by|subject to)(?: the)?(?: terms of)?(?: the)? {name}"))
        out.append(_rule(label, needs, NAME, name))
    for label, needs, body in _table(NOTICES):
        out.append(_rule(label, needs, HINT, expand(body)))
    return out
