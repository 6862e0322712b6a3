"""Signature rules for license texts, notices and names, in order of priority.

A rule is ``label | key words | expression``. Expressions are matched against the words of a text (lower case, joined by one space) and
end at word borders. A rule runs only on texts that hold all its key words, so every match of its expression has to hold them.
"""

from __future__ import annotations

import re
from typing import NamedTuple

# ---- fixed values: license names, identifiers and phrases as they are written in notices ----

PHRASES = """
mit | mit | under the mit license
apache-2 | apache version | apache license version 2
cc-by-nc | cc nc | cc by nc
"""

#: Identifiers of the public license list, as words, and the label they stand for.
IDENTIFIERS = """
0bsd 0bsd; afl 3 0 afl; agpl 3 0 only agpl-3; agpl 3 0 or later agpl-3; agpl 3 0 agpl-3; apache 1 1 apache-1; apache 2 0 apache-2
artistic 1 0 artistic; artistic 2 0 artistic-2; bsd 1 clause bsd-1-clause; bsd 2 clause patent bsd-2-clause; bsd 2 clause bsd-2-clause
bsd 3 clause clear bsd-3-clause-clear; bsd 3 clause bsd-3-clause; bsd 4 clause bsd-4-clause; bsl 1 0 boost-1; busl 1 1 business-source
cc0 1 0 cc0; cddl 1 0 cddl; cddl 1 1 cddl; cecill 2 1 cecill; cern ohl s 2 0 cern-ohl; cpl 1 0 cpl; ecl 2 0 ecl-2; efl 2 0 efl
elastic 2 0 elastic-2; epl 1 0 epl-1; epl 2 0 epl-2; eupl 1 1 eupl; eupl 1 2 eupl; fsfap fsfap; gfdl 1 2 or later gfdl; gfdl 1 3 or later gfdl
gpl 1 0 only gpl-1; gpl 2 0 only gpl-2; gpl 2 0 or later gpl-2; gpl 2 0 gpl-2; gpl 3 0 only gpl-3; gpl 3 0 or later gpl-3; gpl 3 0 gpl-3
hpnd hpnd; icu icu; ijg ijg; ipl 1 0 ipl; isc isc; lgpl 2 0 only lgpl-2; lgpl 2 1 only lgpl-2.1; lgpl 2 1 or later lgpl-2.1; lgpl 2 1 lgpl-2.1
lgpl 3 0 only lgpl-3; lgpl 3 0 or later lgpl-3; lgpl 3 0 lgpl-3; libpng 2 0 libpng; lppl 1 3c lppl; mit 0 mit-0; mit mit; mpl 1 1 mpl-1.1
mpl 2 0 mpl-2; ms pl ms-pl; ms rl ms-rl; mulanpsl 2 0 mulan-psl; ncsa ncsa; odbl 1 0 odbl; odc by 1 0 odc-by; ofl 1 1 ofl; openssl openssl
osl 3 0 osl; pddl 1 0 pddl; php 3 01 php; postgresql postgresql; psf 2 0 python; python 2 0 python; qpl 1 0 qpl; rpl 1 5 rpl; ruby ruby
sspl 1 0 sspl; unicode 3 0 unicode; unicode dfs 2016 unicode; unlicense unlicense; upl 1 0 upl; vim vim; w3c w3c; wtfpl wtfpl; x11 x11; zlib zlib; zpl 2 1 zpl
"""

ADDRESSES = """
apache-2 | apache licenses | (?:www )?apache org licenses license 2 0
mit | opensource mit | opensource org licen[sc]es? mit
bsd-2-clause | opensource bsd | opensource org licen[sc]es? bsd 2 clause
bsd-3-clause | opensource bsd | opensource org licen[sc]es? bsd 3 clause
isc | opensource isc | opensource org licen[sc]es? isc
mpl-2 | mozilla mpl | (?:www )?mozilla org (?:en us )?mpl 2 0
mpl-1.1 | mozilla mpl | (?:www )?mozilla org mpl mpl 1 1
gpl-2 | gnu licenses | (?:www )?gnu org licenses (?:old licenses )?gpl 2 0
gpl-3 | gnu licenses | (?:www )?gnu org licenses gpl 3 0
gpl | gnu licenses | (?:www )?gnu org licenses(?: gpl)?
lgpl-2.1 | gnu licenses | (?:www )?gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-3 | gnu licenses | (?:www )?gnu org licenses lgpl 3 0
agpl-3 | gnu licenses | (?:www )?gnu org licenses agpl(?: 3 0)?
gfdl | gnu licenses | (?:www )?gnu org licenses fdl(?: 1 [23])?
epl-2 | eclipse org | (?:www )?eclipse org legal epl (?:v20|2 0)
epl-1 | eclipse org | (?:www )?eclipse org legal epl v10
boost-1 | boost license | (?:www )?boost org license 1 0
unlicense | unlicense org | unlicense org
wtfpl | wtfpl net | (?:www )?wtfpl net
ofl | sil ofl | scripts sil org ofl
cc0 | creativecommons zero | creativecommons org publicdomain zero 1 0
public-domain | creativecommons mark | creativecommons org publicdomain mark 1 0
odbl | opendatacommons odbl | opendatacommons org licenses odbl(?: 1 0)?
odc-by | opendatacommons by | opendatacommons org licenses by(?: 1 0)?
pddl | opendatacommons pddl | opendatacommons org licenses pddl(?: 1 0)?
elastic-2 | elastic license | (?:www )?elastic co licensing elastic license
sspl | mongodb license | (?:www )?mongodb com licensing server side public license
"""

TITLES = """
agpl-3 | gnu affero | gnu affero general public licen[sc]e(?: (?:as published by the free software foundation )?(?:either )?v(?:ersion)? ?3(?: 0)?| v?3(?: 0)?)?
lgpl-3 | gnu lesser | gnu lesser general public licen[sc]e (?:as published by the free software foundation )?(?:either )?v(?:ersion)? ?3(?: 0)?
lgpl-2.1 | gnu lesser | gnu lesser general public licen[sc]e (?:as published by the free software foundation )?(?:either )?v(?:ersion)? ?2 1
lgpl-2 | gnu library | gnu library general public licen[sc]e(?: v(?:ersion)? ?2(?: 0)?)?
lgpl | gnu lesser | gnu lesser general public licen[sc]e
gfdl | gnu documentation | gnu free documentation licen[sc]e(?: v(?:ersion)? ?1 [0-9])?
gpl-3 | gnu general | gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?v(?:ersion)? ?3(?: 0)?
gpl-2 | gnu general | gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?v(?:ersion)? ?2(?: 0)?
gpl-1 | gnu general | gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?v(?:ersion)? ?1(?: 0)?
gpl | gnu general | gnu general public licen[sc]e(?: v(?:ersion)? ?[0-9]+(?: [0-9]+)?)?
gpl | general public | general public licen[sc]e
apache-2 | apache | apache(?: software)? licen[sc]e v?2(?: 0)?
apache-1 | apache | apache(?: software)? licen[sc]e (?:version )?1 [01]
apache | apache license | (?:the )?apache(?: software)? license
mit-0 | mit attribution | mit no attribution(?: licen[sc]e)?
mit | mit | (?:the )?mit licen[sc]e
mit | expat | (?:the )?expat licen[sc]e
bsd-4-clause | bsd | (?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)(?: licen[sc]e)?
bsd-3-clause | bsd | (?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: licen[sc]e)?
bsd-2-clause | bsd | (?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd)(?: licen[sc]e)?
bsd-2-clause | freebsd | (?:the )?freebsd licen[sc]e
0bsd | bsd | (?:zero clause bsd|0 clause bsd|bsd zero clause)(?: licen[sc]e)?
bsd | bsd | (?:the )?bsd(?: style)? licen[sc]e
isc | isc | (?:the )?isc licen[sc]e
mpl-2 | mozilla public | mozilla public licen[sc]e v(?:ersion)? ?2(?: 0)?
mpl-1.1 | mozilla public | mozilla public licen[sc]e v(?:ersion)? ?1 1
mpl | mozilla public | mozilla public licen[sc]e(?: [0-9](?: [0-9])?)?
epl-2 | eclipse public | eclipse public licen[sc]e (?:v(?:ersion)? ?)?2(?: 0)?
epl-1 | eclipse public | eclipse public licen[sc]e (?:v(?:ersion)? ?)?1(?: 0)?
epl | eclipse public | eclipse public licen[sc]e
cddl | common distribution | common development and distribution licen[sc]e(?: v(?:ersion)? ?1 [01])?
cpl | common public | common public licen[sc]e(?: v(?:ersion)? ?1 0)?
ipl | ibm public | ibm public licen[sc]e
eupl | european union | european union public licen[sc]e(?: v(?:ersion)? ?1 [0-9])?
boost-1 | boost software | boost software licen[sc]e(?: v(?:ersion)? ?1(?: 0)?)?
artistic-2 | artistic | artistic licen[sc]e (?:v(?:ersion)? ?)?2(?: 0)?
artistic | artistic | (?:the )?(?:clarified |perl )?artistic licen[sc]e
ofl | open font | (?:sil )?open font licen[sc]e(?: v(?:ersion)? ?1 [01])?
zlib | zlib | (?:the )?zlib(?: libpng)? licen[sc]e
libpng | libpng | (?:the )?libpng licen[sc]e
wtfpl | fuck public | do what the fuck you want to public licen[sc]e
unlicense | unlicense | (?:the )?unlicense
python | python software | python software foundation licen[sc]e(?: v(?:ersion)? ?2)?
php | php | (?:the )?php licen[sc]e(?: v(?:ersion)? ?3(?: 01)?)?
ruby | ruby | (?:the )?ruby licen[sc]e
perl | perl terms | same terms as perl(?: itself)?
postgresql | postgresql | (?:the )?postgresql licen[sc]e
openssl | openssl | (?:the )?openssl licen[sc]e
ncsa | illinois ncsa | university of illinois ncsa open source licen[sc]e
w3c | w3c | w3c software(?: notice and)? licen[sc]e
x11 | x11 | (?:the )?x11 licen[sc]e
ms-pl | microsoft public | microsoft public licen[sc]e
ms-rl | microsoft reciprocal | microsoft reciprocal licen[sc]e
osl | open license | open software license(?: v(?:ersion)? ?[0-9] [0-9])?
afl | academic free | academic free licen[sc]e(?: v(?:ersion)? ?[0-9] [0-9])?
ecl-2 | educational community | educational community licen[sc]e(?: v(?:ersion)? ?2 0)?
upl | universal permissive | universal permissive licen[sc]e(?: v(?:ersion)? ?1 0)?
cecill | cecill | cecill(?: [abc])?(?: free software)? licen[sc]e
lppl | latex project | latex project public licen[sc]e
mulan-psl | mulan permissive | mulan permissive software licen[sc]e(?: v(?:ersion)? ?2)?
sspl | server public | server side public licen[sc]e(?: v(?:ersion)? ?1)?
business-source | business source | business source licen[sc]e(?: v(?:ersion)? ?1 1)?
elastic-2 | elastic | (?:the )?elastic licen[sc]e(?: v(?:ersion)? ?2(?: 0)?)?
commons-clause | commons clause | commons clause(?: licen[sc]e)? condition
odbl | open database | open database licen[sc]e(?: odbl)?
odc-by | commons attribution | open data commons attribution licen[sc]e
pddl | domain dedication | public domain dedication and licen[sc]e
openrail | responsible ai | (?:creative ml )?(?:open )?responsible ai licen[sc]es?
llama | llama community | llama [0-9] (?:[0-9] )?community licen[sc]e(?: agreement)?
cc0 | cc0 | cc0(?: 1 0)?(?: universal)?
cc0 | creative zero | creative commons zero(?: v?1 0)?(?: universal)?
cern-ohl | cern hardware | cern open hardware licen[sc]e
hpnd | historical permission | historical permission notice and disclaimer
vim | vim | (?:the )?vim licen[sc]e
qpl | q public | q public licen[sc]e
zpl | zope public | zope public licen[sc]e
sleepycat | sleepycat | (?:the )?sleepycat licen[sc]e
ijg | independent jpeg | independent jpeg group licen[sc]e
beerware | beerware | (?:the )?beerware licen[sc]e
json | json | (?:the )?json licen[sc]e
curl | curl | (?:the )?curl licen[sc]e
"""

GRANTS = """
mit | hereby obtaining | permission is hereby granted free of charge to any person obtaining a copy
mit | notice copies | the above copyright notice and this permission notice shall be included in all copies
mit | deal restriction | deal in the software without restriction
isc | fee hereby | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | fee hereby | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted
hpnd | permission documentation | permission to use copy modify and distribute this software and its documentation for any purpose
bsd | redistribution binary | redistribution and use in source and binary forms with or without modification are permitted
bsd-2-clause | redistributions retain | redistributions of source code must retain the above copyright notice
bsd-3-clause | neither contributors | neither the name of (?:[^ ]+ ){1,12}nor the names of (?:its|the) contributors may be used to endorse
bsd-4-clause | advertising mentioning | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd | merchantability disclaimed | implied warranties of merchantability and fitness for a particular purpose are disclaimed
apache-2 | except compliance | you may not use this file except in compliance with the license
apache-2 | perpetual worldwide | perpetual worldwide non exclusive no charge royalty free irrevocable copyright license
gpl | redistribute gnu | you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e
gpl | hope useful | distributed in the hope that it will be useful but without any warranty
gpl | verbatim changing | everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed
lgpl | redistribute lesser | redistribute it and or modify it under the terms of the gnu lesser general public licen[sc]e
agpl-3 | redistribute affero | redistribute it and or modify it under the terms of the gnu affero general public licen[sc]e
mpl-2 | source mozilla | this source code form is subject to the terms of the mozilla public licen[sc]e
epl | accompanying eclipse | this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e
boost-1 | boost distributed | distributed under the boost software license
zlib | origin misrepresented | the origin of this software must not be misrepresented
zlib | altered plainly | altered source versions must be plainly marked as such
unlicense | unencumbered domain | this is free and unencumbered software released into the public domain
wtfpl | fuck want | you just do what the fuck you want to
beerware | retain whatever | as long as you retain this notice you can do whatever you want
json | good evil | the software shall be used for good not evil
cc0 | waived extent | to the extent possible under law (?:[^ ]+ ){1,12}has waived all copyright
public-domain | public domain | (?:dedicated|released|placed|donated) (?:to|into|in) the public domain
public-domain | public domain | (?:is|are) (?:hereby )?(?:in|within) the public domain
public-domain | copyright dedicate | dedicate any and all copyright interest
proprietary | proprietary confidential | (?:proprietary and confidential|confidential and proprietary)
proprietary | unauthorized copying | unauthorized copying (?:[^ ]+ ){0,8}(?:is )?strictly prohibited
"""

MENTIONS = """
mit | mit | (?:mit licensed|licensed mit|license mit|(?:under|with) (?:the )?mit)
apache-2 | apache | (?:under|license|with) (?:the )?apache v?2(?: 0)?
apache-2 | apachev2 | apachev2
bsd | bsd | (?:bsd licensed|(?:under|license) (?:the )?bsd)
gpl-2 | gplv2 | gplv2(?: or later)?
gpl-3 | gplv3 | gplv3(?: or later)?
gpl-2 | gpl | (?:gnu )?gpl (?:v(?:ersion)? ?)?2(?: 0)?
gpl-3 | gpl | (?:gnu )?gpl (?:v(?:ersion)? ?)?3(?: 0)?
gpl | gpl | (?:under|license|gnu) (?:the )?gpl
lgpl-2.1 | lgplv2 | lgplv2(?: 1)?
lgpl-3 | lgplv3 | lgplv3
lgpl-2.1 | lgpl | (?:gnu )?lgpl (?:v(?:ersion)? ?)?2 1
lgpl-3 | lgpl | (?:gnu )?lgpl (?:v(?:ersion)? ?)?3(?: 0)?
lgpl | lgpl | (?:under|license|gnu) (?:the )?lgpl
agpl-3 | agplv3 | agplv3
agpl-3 | agpl | (?:(?:under|license|gnu) (?:the )?agpl|agpl (?:v(?:ersion)? ?)?3(?: 0)?)
mpl-2 | mplv2 | mplv2
mpl-2 | mpl | mpl (?:v(?:ersion)? ?)?2(?: 0)?
epl-2 | epl | epl (?:v(?:ersion)? ?)?2(?: 0)?
cddl | cddl | cddl(?: 1 [01])?
wtfpl | wtfpl | wtfpl(?: v?2)?
ofl | ofl | (?:sil ofl|ofl 1 1)
cc0 | cc | cc zero
llama | llama | llama (?:[0-9] )?licen[sc]e
"""

GENERAL = """
all-rights-reserved | rights reserved | all rights reserved
creative-commons | creative commons | (?:under a )?creative commons(?: licen[sc]e)?
unknown-license | licensed | (?:is|are) licensed under (?:the (?:terms of )?)?(?:[^ ]+ ){1,4}licen[sc]e(?: v(?:ersion)? ?[0-9]+(?: [0-9]+)?)?
unknown-license | released | released under the (?:[^ ]+ ){1,4}licen[sc]e(?: v(?:ersion)? ?[0-9]+(?: [0-9]+)?)?
unknown-license | license | (?:see|refer to) (?:the )?(?:file )?license(?: txt| md| file)? for (?:more |further |license )?(?:details|information|terms|copying)
"""

# ---- rules made from these values ----

#: Priority (the order) and how sure a detection of the tier is.
TIERS = {"phrase": 1.0, "tag": 1.0, "address": 0.95, "title": 0.9, "grant": 0.85, "mention": 0.7, "general": 0.4}
VARIANTS = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?"}


class Rule(NamedTuple):
    tier: str
    label: str
    keys: tuple[str, ...]
    expression: str


def _listed(tier: str, lines: str) -> list[Rule]:
    split = (line.split(" | ") for line in lines.strip().splitlines())
    return [Rule(tier, label, tuple(keys.split()), expression) for label, keys, expression in split]


def _tags() -> list[Rule]:
    items = [item.strip().rsplit(" ", 1) for line in IDENTIFIERS.strip().splitlines() for item in line.split(";")]
    return [Rule("tag", label, ("spdx", "identifier"), f"spdx license identifier {name}") for name, label in items]


def _commons() -> list[Rule]:
    """The licenses of the Creative Commons family: as a tag, an address, an abbreviation and in words."""
    out = []
    for parts in (("by",), ("by", "sa"), ("by", "nc"), ("by", "nd"), ("by", "nc", "sa"), ("by", "nc", "nd")):
        label, short = "cc-" + "-".join(parts), " ".join(parts)
        words = r" (?:and )?".join(VARIANTS[p] for p in parts)
        out += [
            Rule("tag", label, ("spdx", "identifier"), rf"spdx license identifier cc {short} [1-4] [05]"),
            Rule("address", label, ("creativecommons", "licenses"), rf"creativecommons org licenses {short}(?: [1-4] [05])?"),
            Rule("title", label, ("cc", *parts), rf"cc {short}(?: v?[1-4](?: [05])?)?"),
            Rule("title", label, ("creative", "commons"), rf"creative commons {words}(?: [1-4] [05])?(?: international| unported| generic)?(?: (?:public )?licen[sc]e)?"),
        ]
    return out


RULES: list[Rule] = sorted(
    _listed("phrase", PHRASES) + _tags() + _listed("address", ADDRESSES) + _listed("title", TITLES) + _commons()
    + _listed("grant", GRANTS) + _listed("mention", MENTIONS) + _listed("general", GENERAL),
    key=lambda rule: list(TIERS).index(rule.tier))


def compiled(rules: list[Rule]) -> list[re.Pattern]:
    return [re.compile(rb" (?:" + rule.expression.encode() + rb")(?= )") for rule in rules]
