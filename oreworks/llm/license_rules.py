"""The signature rules of the license scan.

Rules are matched against normalised text: lower-case words, one blank between them. In a
rule `#` stands for a version number and `~` for up to three words of any kind.
"""

from __future__ import annotations

from dataclasses import dataclass

#: Kinds of rule: how much a detection counts against others, and how sure it is.
NOTICE, NAMED, TAG, HINT = 4, 3, 2, 1
CONFIDENCE = {NOTICE: 1.0, NAMED: 0.9, TAG: 0.8, HINT: 0.4}

VERSION = r"v?(?:ersion )?\d+(?: \d+){0,2}"
GAP = r"(?:\S+ ){0,3}?"


@dataclass(frozen=True)
class Rule:
    """regex is tried only on texts that contain keyword."""

    label: str
    priority: int
    keyword: str
    regex: str


#: Phrases and labels that are always counted and always stay.
BASE = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

#: label | keyword | name in texts. Each gives a rule for the bare name, and one for a grant
#: under that name ("licensed under the ...").
NAMES = """
agpl-3.0 | affero | gnu affero general public license(?: #)?
agpl-3.0 | agpl | agpl #
gpl-1.0 | gnu | gnu general public license v?(?:ersion )?1(?: 0)?
gpl-2.0 | gnu | gnu general public license v?(?:ersion )?2(?: 0)?
gpl-3.0 | gnu | gnu general public license v?(?:ersion )?3(?: 0)?
gpl-1.0 | gpl | gpl v?1(?: 0)?
gpl-2.0 | gpl | gpl v?2(?: 0)?
gpl-3.0 | gpl | gpl v?3(?: 0)?
gpl-2.0 | gplv2 | gplv2
gpl-3.0 | gplv3 | gplv3
lgpl-2.0 | library general | gnu library general public license(?: #)?
lgpl-2.1 | lesser | gnu lesser general public license v?(?:ersion )?2(?: 1)?
lgpl-3.0 | lesser | gnu lesser general public license v?(?:ersion )?3(?: 0)?
lgpl | lesser | gnu lesser general public license
lgpl-2.1 | lgpl | lgpl v?2(?: 1)?
lgpl-3.0 | lgpl | lgpl v?3(?: 0)?
gfdl | free documentation | gnu free documentation license(?: #)?
gfdl | gfdl | gfdl #
apache-1.0 | apache | apache license v?(?:ersion )?1 0
apache-1.1 | apache | apache license v?(?:ersion )?1 1
apache-2.0 | apache | apache license v?(?:ersion )?2(?: 0)?
apache-2.0 | apache | apache 2 0 license
apache-1.1 | apache software | apache software license(?: #)?
mit | mit | (?:the )?mit license
mit | expat | (?:mit )?expat license
mit-0 | no attribution | mit no attribution(?: license)?
x11 | x11 | x11 license
bsd-4-clause | clause | (?:4|four) clause bsd license
bsd-3-clause | clause | (?:3|three) clause bsd license
bsd-2-clause | clause | (?:2|two) clause bsd license
bsd-3-clause | clause | bsd (?:3|three) clause(?: license)?
bsd-2-clause | clause | bsd (?:2|two) clause(?: license)?
bsd-4-clause | clause | bsd (?:4|four) clause(?: license)?
0bsd | clause | (?:0|zero) clause bsd(?: license)?
bsd | bsd | (?:new |modified |revised |simplified )?bsd(?: style)? license
isc | isc | isc license
mpl-1.0 | mozilla | mozilla public license v?(?:ersion )?1 0
mpl-1.1 | mozilla | mozilla public license v?(?:ersion )?1 1
mpl-2.0 | mozilla | mozilla public license v?(?:ersion )?2(?: 0)?
mpl | mozilla | mozilla public license
mpl-2.0 | mpl | mpl v?2(?: 0)?
epl-1.0 | eclipse | eclipse public license v?(?:ersion )?1(?: 0)?
epl-2.0 | eclipse | eclipse public license v?(?:ersion )?2(?: 0)?
epl | eclipse | eclipse public license
edl-1.0 | eclipse | eclipse distribution license(?: #)?
cddl-1.0 | distribution license | common development and distribution license(?: #)?
cddl-1.0 | cddl | cddl(?: #)?
cpl-1.0 | common public | common public license(?: #)?
cpal-1.0 | attribution license | common public attribution license(?: #)?
ipl-1.0 | ibm public | ibm public license(?: #)?
eupl-1.1 | european union | european union public licen[cs]e v?(?:ersion )?1 1
eupl-1.2 | european union | european union public licen[cs]e(?: v?(?:ersion )?1 2)?
eupl-1.2 | eupl | eupl(?: #)?
osl-3.0 | open software | open software license(?: #)?
afl-3.0 | academic free | academic free license(?: #)?
ecl-2.0 | educational community | educational community license(?: #)?
artistic-1.0 | artistic | artistic license v?(?:ersion )?1(?: 0)?
artistic-2.0 | artistic | artistic license v?(?:ersion )?2(?: 0)?
artistic | artistic | artistic license
bsl-1.0 | boost | boost software license(?: #)?
busl-1.1 | business source | business source license(?: #)?
sspl-1.0 | server side | server side public license(?: #)?
elastic-2.0 | elastic | elastic license(?: #)?
zlib | zlib | zlib(?: libpng)? license
libpng | libpng | (?:libpng|png reference library) license(?: #)?
openssl | openssl | openssl license
ssleay | ssleay | ssleay license
curl | curl | curl license
ncsa | ncsa | (?:university of illinois )?ncsa open source license
postgresql | postgresql | postgresql licen[cs]e
python-2.0 | python software | python software foundation license(?: #)?
psf-2.0 | psf | psf license(?: #)?
php-3.01 | php | php license(?: #)?
ruby | ruby | ruby license
perl | perl | same terms as perl(?: itself)?
vim | vim | vim license
w3c | w3c | w3c (?:software )?(?:notice and )?license
unicode | unicode | unicode (?:terms of use|license agreement|license v?3)
icu | icu | icu license
ofl-1.1 | open font | (?:sil )?open font license(?: #)?
ofl-1.1 | ofl | ofl #
ftl | freetype | freetype (?:project )?license
ijg | jpeg group | independent jpeg group license
ms-pl | microsoft public | microsoft public license
ms-rl | microsoft reciprocal | microsoft reciprocal license
upl-1.0 | universal permissive | universal permissive license(?: #)?
unlicense | unlicense | unlicense
wtfpl | what the | do what the \\S+ you want to public license
wtfpl | wtfpl | wtfpl
beerware | beer | beer ?ware license
mulan-2.0 | mulan | mulan (?:permissive software|psl) license(?: #)?
cecill-2.1 | cecill | cecill(?: [bc])?(?: #)?
qpl-1.0 | q public | q public license(?: #)?
sleepycat | sleepycat | sleepycat license
zpl-2.1 | zope | zope public license(?: #)?
odbl-1.0 | open database | open (?:data commons )?(?:open )?database license(?: #)?
odc-by-1.0 | open data | open data commons attribution license(?: #)?
pddl-1.0 | public domain dedication | (?:open data commons )?public domain dedication and license(?: #)?
cdla-permissive-2.0 | community data | community data license agreement permissive(?: #)?
cdla-sharing-1.0 | community data | community data license agreement sharing(?: #)?
ogl-uk-3.0 | open government | open government licen[cs]e(?: #)?
llama | llama | llama (?:\\d ){0,2}community license(?: agreement)?
openrail | rail | (?:creativeml )?open ?rail(?: \\S)?(?: license)?
gemma | gemma | gemma (?:terms of use|license)
cc0-1.0 | cc0 | cc0(?: #)?(?: universal)?
cc0-1.0 | zero | creative commons zero(?: #)?(?: universal)?
cc-by-nc-nd | cc by nc nd | cc by nc nd(?: #)?
cc-by-nc-sa | cc by nc sa | cc by nc sa(?: #)?
cc-by-nc | cc by nc | cc by nc(?: #)?
cc-by-nd | cc by nd | cc by nd(?: #)?
cc-by-sa | cc by sa | cc by sa(?: #)?
cc-by-1.0 | cc by | cc by 1 0
cc-by-2.0 | cc by | cc by 2 0
cc-by-2.5 | cc by | cc by 2 5
cc-by-3.0 | cc by | cc by 3 0
cc-by-4.0 | cc by | cc by 4 0
cc-by-nc-nd | commons | creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: #)?
cc-by-nc-sa | commons | creative commons attribution non ?commercial share ?alike(?: #)?
cc-by-nc | commons | creative commons attribution non ?commercial(?: #)?
cc-by-nd | commons | creative commons attribution no ?deriv(?:ative)?s?(?: #)?
cc-by-sa | commons | creative commons attribution share ?alike(?: #)?
cc-by-4.0 | commons | creative commons attribution 4 0
cc-by-3.0 | commons | creative commons attribution 3 0
cc-by | commons | creative commons attribution(?: license)?
creative-commons | commons | creative commons(?: \\S+)? license
"""

#: kind | label | keyword | signature: sentences of licenses and notices, and loose hints.
SIGNATURES = """
notice | mit | permission is hereby | permission is hereby granted free of charge to any person obtaining a copy
notice | mit | deal in the software | to deal in the software without restriction including without limitation the rights
notice | mit | as is | the software is provided as is without warranty of any kind express or implied
notice | isc | permission to use | permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted
notice | bsd | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted
notice | bsd | redistributions of | redistributions of source code must retain the above copyright notice
notice | bsd | redistributions in | redistributions in binary form must reproduce the above copyright notice
notice | bsd-3-clause | neither the name | neither the name of ~(?:\\S+ ){0,8}?may be used to endorse or promote products
notice | bsd-4-clause | advertising materials | all advertising materials mentioning features or use of this software
notice | gpl | free software | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
notice | lgpl | free software | this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license
notice | gpl | without any warranty | distributed in the hope that it will be useful but without any warranty
notice | gpl | you should have received | you should have received a copy of the gnu ~general public license
notice | gpl-2.0-or-later | at your option | either version 2 of the license or at your option any later version
notice | gpl-3.0-or-later | at your option | either version 3 of the license or at your option any later version
notice | lgpl-2.1-or-later | at your option | either version 2 1 of the license or at your option any later version
notice | apache-2.0 | licensed under | licensed under the apache license version 2 0 the license
notice | apache-2.0 | you may not use | you may not use this file except in compliance with the license
notice | apache-2.0 | apache org | http www apache org licenses license 2 0
notice | mpl-2.0 | source code form | this source code form is subject to the terms of the mozilla public license v 2 0
notice | epl | accompanying materials | this program and the accompanying materials are made available under the terms of the eclipse public license
notice | boost | person or organization | permission is hereby granted free of charge to any person or organization obtaining a copy of the software
notice | zlib | in no event | this software is provided as is without any express or implied warranty in no event will the authors be held liable
notice | unlicense | unencumbered | free and unencumbered software released into the public domain
notice | artistic | standard version | you may make and give away verbatim copies of the source form of the standard version
notice | cc-by | attribution | this work is licensed under a creative commons attribution
notice | cc0-1.0 | waived | has waived all copyright and related or neighboring rights
named | public-domain | public domain | (?:released|placed|dedicated) (?:in|into|to) the public domain
named | proprietary | proprietary | (?:proprietary and confidential|confidential and proprietary)
named | proprietary | unauthorized | unauthorized (?:copying|use|reproduction|distribution) (?:or \\S+ )?of this ~(?:is|without)
named | proprietary | not be reproduced | may not be reproduced ~without
named | commercial | commercial license | commercial license(?: agreement)?
named | eula | end user license | end user license agreement
named | cc-by | creativecommons org | creativecommons org licenses by(?: #)?
named | cc-by-sa | creativecommons org | creativecommons org licenses by sa(?: #)?
named | cc-by-nc | creativecommons org | creativecommons org licenses by nc(?: #)?
named | cc0-1.0 | creativecommons org | creativecommons org publicdomain zero(?: #)?
named | gpl | gnu org | gnu org licenses gpl
named | lgpl | gnu org | gnu org licenses lgpl
named | agpl-3.0 | gnu org | gnu org licenses agpl
tag | gpl-2.0-only | spdx | spdx license identifier gpl 2 0(?: only)?
tag | gpl-2.0-or-later | spdx | spdx license identifier gpl 2 0 or later
tag | gpl-3.0-only | spdx | spdx license identifier gpl 3 0(?: only)?
tag | gpl-3.0-or-later | spdx | spdx license identifier gpl 3 0 or later
tag | lgpl-2.1 | spdx | spdx license identifier lgpl 2 1(?: only| or later)?
tag | lgpl-3.0 | spdx | spdx license identifier lgpl 3 0(?: only| or later)?
tag | agpl-3.0 | spdx | spdx license identifier agpl 3 0(?: only| or later)?
tag | apache-2.0 | spdx | spdx license identifier apache 2 0
tag | mit | spdx | spdx license identifier mit
tag | bsd-2-clause | spdx | spdx license identifier bsd 2 clause
tag | bsd-3-clause | spdx | spdx license identifier bsd 3 clause
tag | isc | spdx | spdx license identifier isc
tag | mpl-2.0 | spdx | spdx license identifier mpl 2 0
tag | epl-2.0 | spdx | spdx license identifier epl 2 0
tag | unlicense | spdx | spdx license identifier unlicense
tag | cc0-1.0 | spdx | spdx license identifier cc0 1 0
tag | cc-by-4.0 | spdx | spdx license identifier cc by 4 0
tag | zlib | spdx | spdx license identifier zlib
hint | spdx | spdx | spdx license identifier
hint | copyright | copyright | copyright(?: c)?(?: \\d{4})?
hint | rights-reserved | rights reserved | (?:all|some) rights reserved
hint | license | licensed under | licensed under(?: the terms of)?(?: the)?
hint | license | license agreement | license agreement
hint | license | license file | see (?:the )?license file
hint | license | license for | see the license for ~details
hint | license | terms of the | under the terms of the
"""

KINDS = {"notice": NOTICE, "named": NAMED, "tag": TAG, "hint": HINT}

GRANT = (
    r"(?:licensed|released|distributed|available|published|provided|covered|governed) "
    r"(?:under|by) (?:the terms of )?(?:the |a |an )?"
)

#: A text without any of these substrings, in lower case, and without the words `cc by` or
#: `cc 0` matches no rule and no base phrase.
ROOTS = (
    "licen copyright rights gpl apache cc0 gnu mpl spdx cddl cecill wtfpl eupl ofl gfdl"
    " commons domain warranty redistribut permission proprietary confidential reproduced"
    " openrail terms advertising endorse perl unencumbered neighboring unauthorized verbatim"
    " clause rail attribution"
).split()


def _lines(table: str) -> list[list[str]]:
    return [[x.strip() for x in line.split(" | ")] for line in table.strip().splitlines()]


def _expand(signature: str) -> str:
    text = signature.replace("~", GAP).replace("\\\\", "\\").strip()
    return text.replace("#", VERSION)


def rules() -> list[Rule]:
    found = []
    for label, keyword, name in _lines(NAMES):
        found.append(Rule(label, NAMED, keyword, _expand(name)))
        found.append(Rule(label, NOTICE, keyword, GRANT + _expand(name)))
    for kind, label, keyword, signature in _lines(SIGNATURES):
        found.append(Rule(label, KINDS[kind], keyword, _expand(signature)))
    return found
