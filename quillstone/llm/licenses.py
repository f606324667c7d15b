"""Operator 4: license scans by ordered signature rules, gated by keywords; overlapping detections are resolved by priority and containment."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import ship

#: Base phrases with their labels, in lower case.
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
#: Hand-written signature rules, in order of priority. A line: label; weight; keywords of which every match contains one (with | between them); pattern over lower-case words joined by single spaces.
#: Texts of licenses and identifiers come first, then notices, names with versions, names, and what only hints at a license. Of labels that share words, the narrower one stands first.
SIGNATURES = r"""
mit; 1.0; permission is hereby; permission is hereby granted free of charge to any person obtaining a copy of this software
mit; 1.0; copyright notice and this permission; the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
x11; 1.0; x consortium; except as contained in this notice the name of the x consortium shall not be used in advertising
isc; 1.0; permission to use; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc; 0.95; permission to use; permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted
0bsd; 1.0; permission to use; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is
bsd-4; 1.0; advertising materials; all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-3; 1.0; endorse or promote; neither the names? of .{0,80}? nor the names of (?:its|their|any) contributors may be used to endorse or promote
bsd-3; 0.95; endorse or promote; may not be used to endorse or promote products derived from this software without specific prior written permission
bsd; 0.9; redistribution and use; redistribution and use in source and binary forms with or without modification are permitted
apache-2; 1.0; apache; licensed under the apache license version 2 0 the license you may not use this file except in compliance
apache-2; 1.0; asf; licensed to the apache software foundation asf under one or more contributor license agreements
apache-2; 0.9; compliance with the license; you may not use this file except in compliance with the license
apache-1.1; 1.0; apache software foundation; this product includes software developed by the apache software foundation
gpl-2; 1.0; general public; gnu general public license as published by the free software foundation (?:either )?version 2
gpl-3; 1.0; general public; gnu general public license as published by the free software foundation (?:either )?version 3
lgpl-2; 1.0; general public; gnu (?:lesser|library) general public license as published by the free software foundation (?:either )?version 2
lgpl-3; 1.0; general public; gnu lesser general public license as published by the free software foundation (?:either )?version 3
agpl-3; 1.0; general public; gnu affero general public license as published by the free software foundation (?:either )?version 3
gpl; 0.95; free software; this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
lgpl; 0.95; free software; this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license
agpl; 0.95; free software; this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license
gpl; 0.9; copies of this license; everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed
mpl-2; 1.0; mozilla; this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1; 1.0; mozilla; the contents of this file are subject to the mozilla public license version 1 [01]
cddl; 1.0; common development; the contents of this file are subject to the terms of the common development and distribution license
epl-2; 1.0; eclipse; made available under the terms of the eclipse public license (?:v |version )?2 0
epl-1; 1.0; eclipse; made available under the terms of the eclipse public license (?:v |version )?1 0
edl; 1.0; eclipse; made available under the terms of the eclipse distribution license
cpl; 1.0; common public; made available under the terms of the common public license
unlicense; 1.0; unencumbered; this is free and unencumbered software released into the public domain
zlib; 1.0; be held liable; in no event will the authors be held liable for any damages arising from the use of this software
zlib; 0.95; origin of this software; the origin of this software must not be misrepresented
boost; 1.0; permission is hereby; permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
wtfpl; 1.0; what the; you just do what the \w+ you want to
artistic-2; 1.0; artistic; everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed preamble this license establishes the terms under which a given free software package may be copied .{0,200}? artistic
openssl; 1.0; openssl; this product includes software developed by the openssl project
openssl; 1.0; eric young; this product includes cryptographic software written by eric young
python-2; 1.0; python software foundation; this license agreement is between the python software foundation psf
php-3; 1.0; php; this product includes php software freely available from
ofl-1.1; 1.0; open font; this font software is licensed under the sil open font license version 1 1
cc0; 1.0; cc0; the person who associated a work with this deed has dedicated the work to the public domain .{0,200}? cc0
cc-by; 0.95; creative commons; this work is licensed under (?:a|the) creative commons attribution (?:[1-4] [05] )?(?:international |unported )?license
gpl-1; 1.0; gpl; spdx licen[cs]e identifier gpl 1 0(?: only| or later)?
gpl-2; 1.0; gpl; spdx licen[cs]e identifier gpl 2 0(?: only| or later)?
gpl-3; 1.0; gpl; spdx licen[cs]e identifier gpl 3 0(?: only| or later)?
lgpl-2; 1.0; lgpl; spdx licen[cs]e identifier lgpl 2 [01](?: only| or later)?
lgpl-3; 1.0; lgpl; spdx licen[cs]e identifier lgpl 3 0(?: only| or later)?
agpl-3; 1.0; agpl; spdx licen[cs]e identifier agpl 3 0(?: only| or later)?
mit-0; 1.0; mit; spdx licen[cs]e identifier mit 0
mit; 1.0; mit; spdx licen[cs]e identifier mit
apache-2; 1.0; apache; spdx licen[cs]e identifier apache 2 0
bsd-2; 1.0; bsd; spdx licen[cs]e identifier bsd 2 clause
bsd-3; 1.0; bsd; spdx licen[cs]e identifier bsd 3 clause
bsd-4; 1.0; bsd; spdx licen[cs]e identifier bsd 4 clause
mpl-2; 1.0; mpl; spdx licen[cs]e identifier mpl 2 0
isc; 1.0; isc; spdx licen[cs]e identifier isc
unlicense; 1.0; unlicense; spdx licen[cs]e identifier unlicense
cc0; 1.0; cc0; spdx licen[cs]e identifier cc0 1 0
gpl-2; 0.9; gpl; gpl 2 0 (?:only|or later)
gpl-3; 0.9; gpl; gpl 3 0 (?:only|or later)
lgpl-2; 0.9; lgpl; lgpl 2 [01] (?:only|or later)
lgpl-3; 0.9; lgpl; lgpl 3 0 (?:only|or later)
agpl-3; 0.9; agpl; agpl 3 0 (?:only|or later)
gpl-1; 0.9; general public; gnu general public license(?: gpl)? (?:version |v )?1(?: 0)?
gpl-2; 0.9; general public; gnu general public license(?: gpl)? (?:version |v )?2(?: 0)?
gpl-2; 0.9; general public; gnu general public license v2(?: 0)?
gpl-2; 0.9; general public; version 2(?: 0)? of the gnu general public license
gpl-2; 0.8; gpl; (?:gnu )?gpl (?:version |v )?2(?: 0)?
gpl-2; 0.8; gplv2; (?:gnu )?gplv2(?: 0)?
gpl-2; 0.8; gpl v2; (?:gnu )?gpl v2(?: 0)?
gpl-2; 0.8; gpl2; gpl2
gpl-3; 0.9; general public; gnu general public license(?: gpl)? (?:version |v )?3(?: 0)?
gpl-3; 0.9; general public; gnu general public license v3(?: 0)?
gpl-3; 0.9; general public; version 3(?: 0)? of the gnu general public license
gpl-3; 0.8; gpl; (?:gnu )?gpl (?:version |v )?3(?: 0)?
gpl-3; 0.8; gplv3; (?:gnu )?gplv3(?: 0)?
gpl-3; 0.8; gpl v3; (?:gnu )?gpl v3(?: 0)?
gpl-3; 0.8; gpl3; gpl3
lgpl-2; 0.9; general public; gnu (?:lesser|library) general public license(?: lgpl)? (?:version |v )?2(?: [01])?
lgpl-2; 0.9; general public; gnu (?:lesser|library) general public license v2(?: [01])?
lgpl-2; 0.9; general public; version 2(?: [01])? of the gnu (?:lesser|library) general public license
lgpl-2; 0.8; lgpl; (?:gnu )?lgpl (?:version |v )?2(?: [01])?
lgpl-2; 0.8; lgplv2; (?:gnu )?lgplv2(?: [01])?
lgpl-2; 0.8; lgpl v2; (?:gnu )?lgpl v2(?: [01])?
lgpl-3; 0.9; general public; gnu lesser general public license(?: lgpl)? (?:version |v )?3(?: 0)?
lgpl-3; 0.9; general public; gnu lesser general public license v3(?: 0)?
lgpl-3; 0.9; general public; version 3(?: 0)? of the gnu lesser general public license
lgpl-3; 0.8; lgpl; (?:gnu )?lgpl (?:version |v )?3(?: 0)?
lgpl-3; 0.8; lgplv3; (?:gnu )?lgplv3(?: 0)?
lgpl-3; 0.8; lgpl v3; (?:gnu )?lgpl v3(?: 0)?
agpl-3; 0.9; affero; (?:gnu )?affero general public license(?: agpl)? (?:version |v )?3(?: 0)?
agpl-3; 0.9; affero; (?:gnu )?affero general public license v3(?: 0)?
agpl-3; 0.8; agpl; (?:gnu )?agpl (?:version |v )?3(?: 0)?
agpl-3; 0.8; agplv3; (?:gnu )?agplv3(?: 0)?
agpl-3; 0.8; agpl v3; (?:gnu )?agpl v3(?: 0)?
agpl-1; 0.9; affero; affero general public license (?:version |v )?1(?: 0)?
agpl; 0.8; affero; (?:gnu )?affero general public license
agpl; 0.6; agpl; (?:gnu )?agpl licen[cs]ed?
lgpl; 0.8; general public; (?:gnu )?(?:lesser|library) general public license
lgpl; 0.6; lgpl; (?:gnu )?lgpl
gpl; 0.8; general public; (?:gnu )?general public license
gpl; 0.6; gnu gpl; gnu gpl
gpl; 0.6; gpl; gpl(?: compatible)? licen[cs]ed?
gpl; 0.6; gpl; (?:licensed|released|distributed|available) under (?:the )?gpl(?! v?[0-9])
gfdl-1.3; 0.9; documentation; (?:gnu )?free documentation license(?: gfdl)? (?:version |v )?1 3
gfdl-1.2; 0.9; documentation; (?:gnu )?free documentation license(?: gfdl)? (?:version |v )?1 2
gfdl-1.1; 0.9; documentation; (?:gnu )?free documentation license(?: gfdl)? (?:version |v )?1 1
gfdl; 0.8; documentation; (?:gnu )?free documentation license
gfdl; 0.7; gfdl; (?:gnu )?gfdl
apache-2; 0.9; apache; apache(?: software)? licen[cs]e (?:version |v )?2(?: 0)?
apache-2; 0.9; apache; apache(?: software)? licen[cs]e v2(?: 0)?
apache-2; 0.8; apache; apache 2(?: 0)?(?: licen[cs]ed?)?
apache-2; 0.8; apache2; apache2(?: licen[cs]ed?)?
apache-2; 0.8; apache; apache v2(?: 0)?
apache-2; 0.8; asl; asl (?:v )?2 0
apache-1.1; 0.9; apache; apache(?: software)? licen[cs]e (?:version |v )?1 1
apache-1.0; 0.9; apache; apache(?: software)? licen[cs]e (?:version |v )?1 0
apache-1.1; 0.8; apache; apache 1 1
apache; 0.6; apache; apache(?: software)? licen[cs]ed?
mit-0; 0.9; no attribution; mit no attribution(?: licen[cs]e)?
mit; 0.9; mit; under the mit licen[cs]e
mit; 0.9; mit; under the terms of the mit licen[cs]e
mit; 0.8; mit; (?:the )?mit licen[cs]ed?
mit; 0.8; mit; mit x11(?: licen[cs]e)?
mit; 0.8; mit; (?:licensed|released|distributed|available|published) under (?:the )?mit(?! no)
mit; 0.7; mit; licen[cs]e mit
mit; 0.8; expat; (?:the )?expat licen[cs]e
mit; 0.8; expat; under (?:the )?expat
x11; 0.8; x11; (?:the )?x11 licen[cs]e
bsd-4; 0.9; bsd; bsd 4 clause(?: licen[cs]e)?
bsd-4; 0.9; bsd; (?:4|four) clause bsd(?: licen[cs]e)?
bsd-4; 0.9; bsd; original bsd(?: licen[cs]e)?
bsd-3; 0.9; bsd; bsd 3 clause(?: licen[cs]e)?
bsd-3; 0.9; bsd; (?:3|three) clause bsd(?: licen[cs]e)?
bsd-3; 0.9; bsd; (?:new|modified|revised) bsd(?: licen[cs]e)?
bsd-3; 0.8; bsd3; bsd3
bsd-2; 0.9; bsd; bsd 2 clause(?: licen[cs]e)?
bsd-2; 0.9; bsd; (?:2|two) clause bsd(?: licen[cs]e)?
bsd-2; 0.9; bsd; (?:simplified bsd|freebsd)(?: licen[cs]e)?
bsd-2; 0.8; bsd2; bsd2
0bsd; 0.9; 0bsd; 0bsd(?: licen[cs]e)?
0bsd; 0.9; bsd; (?:zero|0) clause bsd(?: licen[cs]e)?
bsd; 0.6; bsd; bsd(?: style)? licen[cs]ed?
bsd; 0.6; bsd; under (?:the |a )?bsd(?! [0-9])
mpl-2; 0.9; mozilla; mozilla public licen[cs]e(?: mpl)? (?:version |v )?2(?: 0)?
mpl-2; 0.9; mozilla; mozilla public licen[cs]e v2(?: 0)?
mpl-2; 0.8; mpl; mpl (?:version |v )?2(?: 0)?
mpl-2; 0.8; mplv2; mplv2(?: 0)?
mpl-1; 0.9; mozilla; mozilla public licen[cs]e(?: mpl)? (?:version |v )?1(?: [01])?
mpl-1; 0.8; mpl; mpl (?:version |v )?1 [01]
mpl; 0.7; mozilla; mozilla public licen[cs]e
npl; 0.8; netscape; netscape public licen[cs]e(?: (?:version |v )?1 [01])?
epl-2; 0.9; eclipse; eclipse public licen[cs]e(?: epl)? (?:version |v )?2(?: 0)?
epl-2; 0.9; eclipse; eclipse public licen[cs]e v2(?: 0)?
epl-2; 0.8; epl; epl (?:v )?2 0
epl-1; 0.9; eclipse; eclipse public licen[cs]e(?: epl)? (?:version |v )?1(?: 0)?
epl-1; 0.8; epl; epl (?:v )?1 0
epl; 0.7; eclipse; eclipse public licen[cs]e
edl; 0.8; eclipse; eclipse distribution licen[cs]e(?: (?:version |v )?1(?: 0)?)?
cpl; 0.8; common public; common public licen[cs]e(?: (?:version |v )?1(?: 0)?)?
ipl; 0.8; ibm public; ibm public licen[cs]e(?: (?:version |v )?1(?: 0)?)?
cddl; 0.8; common development; common development and distribution licen[cs]e(?: (?:version |v )?1(?: [01])?)?
cddl; 0.8; cddl; cddl(?: (?:v )?1 [01])?
cpal; 0.8; common public attribution; common public attribution licen[cs]e(?: (?:version |v )?1(?: 0)?)?
isc; 0.8; isc; (?:the )?isc licen[cs]e
isc; 0.7; isc; under (?:the )?isc
zlib; 0.8; zlib; (?:the )?zlib(?: libpng)? licen[cs]e
libpng; 0.8; libpng; (?:the )?libpng licen[cs]e
boost; 0.9; boost; boost software licen[cs]e(?: (?:version |v )?1(?: 0)?)?
boost; 0.8; bsl 1 0; bsl 1 0
busl-1.1; 0.9; business source; business source licen[cs]e(?: (?:version |v )?1 1)?
busl-1.1; 0.8; busl; busl 1 1
sspl; 0.9; server side; server side public licen[cs]e(?: (?:version |v )?1)?
sspl; 0.8; sspl; sspl(?: 1 0| v1)?
elastic-2; 0.9; elastic; elastic licen[cs]e (?:version |v )?2(?: 0)?
commons-clause; 0.8; commons clause; commons clause(?: licen[cs]e)?
unlicense; 0.8; unlicense; (?:the )?unlicense
wtfpl; 0.9; what the; do what the \w+ you want to public licen[cs]e
wtfpl; 0.8; wtfpl; (?:the )?wtfpl
beerware; 0.8; beerware; beerware(?: licen[cs]e)?
artistic-2; 0.9; artistic; artistic licen[cs]e (?:version |v )?2(?: 0)?
artistic-1; 0.9; artistic; artistic licen[cs]e (?:version |v )?1(?: 0)?
artistic; 0.7; artistic; (?:perl )?artistic licen[cs]e
perl; 0.7; same terms as perl; same terms as perl itself
python-2; 0.8; python software foundation; python software foundation licen[cs]e(?: (?:version |v )?2(?: 0)?)?
python-2; 0.8; psf; psf 2 0
python-2; 0.7; psf licen; psf licen[cs]e
php-3; 0.8; php; php licen[cs]e(?: (?:version |v )?3(?: 01?)?)?
ruby; 0.8; ruby; ruby(?: s)? licen[cs]e
postgresql; 0.8; postgresql; postgresql licen[cs]e
openssl; 0.8; openssl; openssl licen[cs]e
curl; 0.8; curl; curl licen[cs]e
vim; 0.8; vim; vim licen[cs]e
tex; 0.8; latex project; latex project public licen[cs]e(?: (?:version |v )?1 [0-3][abc]?)?
tex; 0.8; lppl; lppl(?: 1 [0-3][abc]?)?
ncsa; 0.8; illinois; university of illinois(?: ncsa)?(?: open source)? licen[cs]e
ncsa; 0.8; ncsa; ncsa(?: open source)? licen[cs]e
upl; 0.8; universal permissive; universal permissive licen[cs]e(?: (?:version |v )?1(?: 0)?)?
ms-pl; 0.8; microsoft public; microsoft public licen[cs]e
ms-pl; 0.8; ms pl; ms pl
ms-rl; 0.8; microsoft reciprocal; microsoft reciprocal licen[cs]e
ms-rl; 0.8; ms rl; ms rl
eupl; 0.9; european union; european union public licen[cs]e(?: (?:version |v )?1 [012])?
eupl; 0.8; eupl; eupl(?: (?:v )?1 [012])?
cecill; 0.8; cecill; cecill(?: [bc])?(?: licen[cs]e)?
osl; 0.8; open software; open software licen[cs]e(?: (?:version |v )?[123](?: \d)?)?
osl; 0.8; osl; osl [123] 0
afl; 0.8; academic free; academic free licen[cs]e(?: (?:version |v )?[123](?: \d)?)?
afl; 0.8; afl; afl [123] [01]
ecl-2; 0.8; educational community; educational community licen[cs]e(?: (?:version |v )?2(?: 0)?)?
ofl-1.1; 0.9; open font; (?:sil )?open font licen[cs]e (?:version |v )?1 1
ofl; 0.8; open font; (?:sil )?open font licen[cs]e
ofl-1.1; 0.8; ofl; ofl 1 1
odbl; 0.8; database licen; open (?:data commons open )?database licen[cs]e(?: (?:version |v )?1(?: 0)?)?
odbl; 0.8; odbl; odbl(?: 1 0)?
odc-by; 0.8; data commons attribution; open data commons attribution licen[cs]e
pddl; 0.8; public domain dedication; public domain dedication and licen[cs]e
cdla-permissive; 0.8; community data; community data licen[cs]e agreement permissive(?: (?:version |v )?[12](?: 0)?)?
cdla-sharing; 0.8; community data; community data licen[cs]e agreement sharing(?: (?:version |v )?1(?: 0)?)?
openrail; 0.8; openrail; (?:creativeml |bigscience |bigcode )?openrail(?: m)?(?: licen[cs]e)?
ogl-uk; 0.8; open government; open government licen[cs]e(?: (?:version |v)?[ ]?[123](?: 0)?)?
cc0; 0.9; cc0; (?:creative commons )?cc0(?: 1 0)?(?: universal)?
cc0; 0.8; creative commons zero; creative commons zero
cc-by-nc-nd; 0.9; creative commons; creative commons attribution non ?commercial no ?deriv(?:ative|ative work|atives|ative works|s)?
cc-by-nc-nd; 0.9; cc by; cc by nc nd
cc-by-nc-sa; 0.9; creative commons; creative commons attribution non ?commercial share ?alike
cc-by-nc-sa; 0.9; cc by; cc by nc sa
cc-by-nc; 0.9; creative commons; creative commons attribution non ?commercial
cc-by-nc; 0.9; cc by; cc by nc
cc-by-nd; 0.9; creative commons; creative commons attribution no ?deriv(?:ative|ative work|atives|ative works|s)?
cc-by-nd; 0.9; cc by; cc by nd
cc-by-sa; 0.9; creative commons; creative commons attribution share ?alike
cc-by-sa; 0.9; cc by; cc by sa
cc-by; 0.9; creative commons; creative commons attribution
cc-by; 0.9; cc by; cc by(?: [1-4] [05])?
cc; 0.6; creative commons; (?:a )?creative commons licen[cs]e
public-domain; 0.9; public domain; (?:released|dedicated|placed|given|is|are) (?:in|into|to) the public domain
public-domain; 0.8; public domain mark; public domain mark(?: 1 0)?
public-domain; 0.6; public domain; public domain software
freeware; 0.5; freeware; (?:this (?:software|program) )?is freeware
shareware; 0.5; shareware; (?:this (?:software|program) )?is shareware
proprietary; 0.8; confidential; proprietary and confidential
proprietary; 0.8; confidential; confidential and proprietary
proprietary; 0.7; end user; end user licen[cs]e agreement
proprietary; 0.7; commercial licen; (?:under|requires) a commercial licen[cs]e
proprietary; 0.6; redistribution; redistribution (?:of this \w+ )?is (?:strictly )?prohibited
proprietary; 0.5; without; without (?:the )?(?:prior|express) written (?:permission|consent)
all-rights-reserved; 0.4; rights reserved; all rights reserved
"""


@dataclass(frozen=True)
class Rule:
    label: str
    weight: float
    keywords: tuple[bytes, ...]
    pattern: re.Pattern


def _rule(line: str) -> Rule:
    label, weight, keywords, pattern = line.split("; ", 3)
    return Rule(label, float(weight), tuple(keywords.encode().split(b"|")), re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])".encode()))


RULES = [_rule(line) for line in SIGNATURES.strip().split("\n")]
#: Distinct keywords with the numbers of their rules: a text runs only the rules that have a keyword in it.
GATES = {k: [i for i, r in enumerate(RULES) if k in r.keywords] for r in RULES for k in r.keywords}
#: A-Z to lower case; all that is not of a word to a space. Bytes from 0x80 on belong to words.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _sub(line: bytes, phrase: bytes) -> list[int]:
    """Word numbers of all places, overlapping ones too, where the phrase's words stand in the line of words joined (and framed) by spaces."""
    out, at, word, last = [], line.find(phrase), 0, 0
    while at >= 0:
        word += line.count(b" ", last, at)
        last = at
        out.append(word)
        at = line.find(phrase, at + 1)
    return out


def suppress(found: list[tuple[int, int, int, str, float]]) -> list[tuple[int, int, int, str, float]]:
    """Of finds (start, end, priority, label, weight), taken by priority and then the longest first: one goes if its interval contains that of a kept find or is contained in it. Finds that overlap only in part both stay."""
    kept: list[tuple[int, int, int, str, float]] = []
    starts: list[int] = []  # of kept finds, whose ends ascend with them, as none contains another
    ends: list[int] = []
    for f in sorted(found, key=lambda f: (f[2], f[0] - f[1], f[0])):
        before, after = bisect_right(starts, f[0]) - 1, bisect_left(starts, f[0])
        if (before < 0 or ends[before] < f[1]) and (after == len(starts) or ends[after] > f[1]):
            starts.insert(after, f[0])
            ends.insert(after, f[1])
            kept.append(f)
    return sorted(kept)


def scan(text: str) -> dict:
    """Words, base places and labels of one text; finds holds (first word, end word, rule, label, weight)."""
    words = text.encode("utf-8", "surrogatepass").translate(WORDS).split()
    out = {"n_words": len(words), "starts": [], "base": set(), "finds": []}
    if not words:
        return out
    line = b" " + b" ".join(words) + b" "
    for phrase, label in BASE:
        if places := _sub(line, f" {phrase} ".encode()):
            out["starts"] += places
            out["base"].add(label)
    rules = sorted({i for k, of in GATES.items() if k in line for i in of})
    if rules:
        found = []
        body = line[1:-1]
        for i in rules:
            r = RULES[i]
            at = first = 0
            for m in r.pattern.finditer(body):
                first += body.count(b" ", at, m.start())
                at = m.start()
                found.append((first, first + m[0].count(b" ") + 1, i, r.label, r.weight))
        out["finds"] = suppress(found)
    return out


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column(1):
            s = scan(text.as_py() or "")
            weights = [f[4] for f in s["finds"]] + [1.0] * bool(s["base"])
            rows.append((s["n_words"], len(s["starts"]), min(s["starts"], default=None), max(s["starts"], default=None), ",".join(sorted(s["base"])), ",".join(sorted(s["base"] | {f[3] for f in s["finds"]})), max(weights, default=0.0)))
        n, b, first, last, base, labels, score = zip(*rows, strict=True) if rows else ((),) * 7
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (n, b, first, last)), pa.array(base, pa.string()), pa.array(labels, pa.string()), pa.array(score, pa.float64())], names=COLUMNS)


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per document its words, base places, base labels, all labels and score: the greatest weight among its finds, 1 with a base phrase, 0 with neither.

    Null and empty texts have no words and empty labels. Ids, nulls and repeated rows stay as they are; further columns are not read; an empty table gives no rows. Of finds with the same
    interval the rule that stands first wins. Each text, however long, is scanned whole in the task that reads it; nothing is shuffled.
    """
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_digest, SCHEMA)
