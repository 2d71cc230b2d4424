"""Signature rules for licence notices.

One rule a line: priority, confidence, label and a regular expression over the words of a text in lower
case with single spaces between them (``Apache-2.0`` reads ``apache 2 0``). Optional parts and
alternatives stand in ``(?:...)`` groups only; the longest text outside of them is the rule's keyword.
Priority 9: an identifier or address; 7: a full name with version; 5: a full name; 3: a phrase of the
licence text; 1: a hint.
"""

from __future__ import annotations

import re
from typing import NamedTuple

#: SPDX identifiers in words, with our labels; fixed values.
IDENTIFIERS = """
mit=mit  apache 2 0=apache-2.0  apache 1 1=apache-1.1  bsd 2 clause=bsd-2-clause  bsd 3 clause=bsd-3-clause
bsd 4 clause=bsd-4-clause  0bsd=0bsd  isc=isc  gpl 2 0=gpl-2.0  gpl 3 0=gpl-3.0  lgpl 2 1=lgpl-2.1  lgpl 3 0=lgpl-3.0
agpl 3 0=agpl-3.0  mpl 1 1=mpl-1.1  mpl 2 0=mpl-2.0  epl 1 0=epl-1.0  epl 2 0=epl-2.0  cddl 1 0=cddl-1.0
cc0 1 0=cc0-1.0  cc by 3 0=cc-by-3.0  cc by 4 0=cc-by-4.0  cc by sa 3 0=cc-by-sa-3.0  cc by sa 4 0=cc-by-sa-4.0
cc by nc 4 0=cc-by-nc-4.0  cc by nd 4 0=cc-by-nd-4.0  cc by nc sa 4 0=cc-by-nc-sa-4.0  cc by nc nd 4 0=cc-by-nc-nd-4.0
unlicense=unlicense  wtfpl=wtfpl  zlib=zlib  bsl 1 0=bsl-1.0  artistic 2 0=artistic-2.0  ofl 1 1=ofl-1.1  postgresql=postgresql
python 2 0=python-2.0  psf 2 0=psf-2.0  ncsa=ncsa  eupl 1 2=eupl-1.2  ms pl=ms-pl  ms rl=ms-rl  odbl 1 0=odbl-1.0
mulanpsl 2 0=mulanpsl-2.0  gfdl 1 3=gfdl-1.3  upl 1 0=upl-1.0  ecl 2 0=ecl-2.0  afl 3 0=afl-3.0  osl 3 0=osl-3.0
cecill 2 1=cecill-2.1  ijg=ijg  libpng 2 0=libpng-2.0  openssl=openssl  ruby=ruby  php 3 01=php-3.01  vim=vim  w3c=w3c
x11=x11  unicode 3 0=unicode-3.0  busl 1 1=busl-1.1  sspl 1 0=sspl-1.0  elastic 2 0=elastic-2.0
"""

RULES = r"""
9 .99 mit opensource org licenses mit(?: license)?
9 .99 mit spdx org licenses mit
9 .97 mit license mit(?: license)?
7 .95 mit (?:released|licensed|distributed|available|provided) under the(?: terms of the)? mit license
7 .95 mit (?:is|are) mit licensed
5 .90 mit the mit license
5 .85 mit mit license
5 .85 mit mit licence
5 .90 mit mit expat license
5 .90 mit expat license
3 .80 mit permission is hereby granted free of charge to any person obtaining a copy
3 .75 mit to deal in the software without restriction including without limitation the rights
3 .75 mit the above copyright notice and this permission notice shall be included in all copies
1 .40 mit mit style license
1 .40 mit mit x11 license
9 .99 apache-2.0 apache org licenses license 2 0(?: txt| html)?
9 .99 apache-2.0 opensource org licenses apache 2 0
7 .97 apache-2.0 licensed under the apache license version 2 0
7 .95 apache-2.0 apache license version 2(?: 0)?
7 .95 apache-2.0 apache license 2 0
7 .95 apache-2.0 apache software license version 2(?: 0)?
7 .92 apache-2.0 apache 2 0 license
7 .92 apache-2.0 apache v2 license
7 .92 apache-2.0 apache license v2(?: 0)?
7 .95 apache-1.1 apache software license version 1 1
7 .95 apache-1.0 apache license version 1 0
5 .80 apache apache license
5 .80 apache apache licence
5 .80 apache apache software license
5 .80 apache apache public license
3 .75 apache-2.0 unless required by applicable law or agreed to in writing software distributed under the license
3 .75 apache-2.0 you may not use this file except in compliance with the license
1 .50 apache asf licensed
9 .99 gpl-3.0 gnu org licenses gpl 3 0(?: html| txt| en html)?
9 .99 gpl-2.0 gnu org licenses old licenses gpl 2 0(?: html| txt| en html)?
9 .90 gpl gnu org licenses gpl(?: html| txt)?
9 .99 gpl-3.0 opensource org licenses gpl 3 0
9 .99 gpl-2.0 opensource org licenses gpl 2 0
7 .97 gpl-3.0 gnu general public license(?: gpl)? version 3(?: 0)?
7 .97 gpl-2.0 gnu general public license(?: gpl)? version 2(?: 0)?
7 .97 gpl-1.0 gnu general public license(?: gpl)? version 1(?: 0)?
7 .95 gpl-3.0 gnu general public license v3(?: 0)?
7 .95 gpl-2.0 gnu general public license v2(?: 0)?
7 .95 gpl-3.0 gnu gpl(?: version| v)? 3(?: 0)?
7 .95 gpl-2.0 gnu gpl(?: version| v)? 2(?: 0)?
7 .95 gpl-3.0 gnu gplv3
7 .95 gpl-2.0 gnu gplv2
7 .92 gpl-3.0 gplv3(?: license)?
7 .92 gpl-2.0 gplv2(?: license)?
7 .92 gpl-3.0 gpl version 3
7 .92 gpl-2.0 gpl version 2
7 .90 gpl-3.0 gpl 3 0
7 .90 gpl-2.0 gpl 2 0
7 .96 gpl-3.0-or-later gnu general public license(?: as published by the free software foundation)? either version 3 of the license or at your option any later version
7 .96 gpl-2.0-or-later gnu general public license(?: as published by the free software foundation)? either version 2 of the license or at your option any later version
5 .88 gpl gnu general public license
5 .88 gpl gnu general public licence
5 .80 gpl general public license
5 .80 gpl general public licence
5 .80 gpl gnu gpl
5 .70 gpl gpl license
5 .70 gpl gpl licensed
5 .75 gpl licensed under the gpl
3 .75 gpl free software you can redistribute it and or modify it under the terms
3 .60 gpl any later version this program is distributed in the hope that it will be useful
1 .40 gpl gpl compatible
9 .99 lgpl-3.0 gnu org licenses lgpl 3 0(?: html| txt)?
9 .99 lgpl-2.1 gnu org licenses old licenses lgpl 2 1(?: html| txt)?
9 .90 lgpl gnu org licenses lgpl(?: html| txt)?
8 .97 lgpl-3.0 gnu lesser general public license(?: lgpl)? version 3(?: 0)?
8 .97 lgpl-2.1 gnu lesser general public license(?: lgpl)? version 2 1
8 .97 lgpl-2.0 gnu library general public license(?: lgpl)? version 2(?: 0)?
8 .95 lgpl-3.0 gnu lesser general public license v3(?: 0)?
8 .95 lgpl-2.1 gnu lesser general public license v2 1
7 .92 lgpl-3.0 lgplv3
7 .92 lgpl-2.1 lgplv2 1
7 .92 lgpl-3.0 lgpl(?: version)? 3(?: 0)?
7 .92 lgpl-2.1 lgpl(?: version)? 2 1
6 .88 lgpl gnu lesser general public license
6 .88 lgpl gnu library general public license
6 .85 lgpl lesser general public license
6 .85 lgpl library general public license
5 .75 lgpl lgpl license
5 .75 lgpl gnu lgpl
9 .99 agpl-3.0 gnu org licenses agpl 3 0(?: html| txt)?
8 .97 agpl-3.0 gnu affero general public license(?: agpl)? version 3(?: 0)?
8 .95 agpl-3.0 gnu affero general public license v3(?: 0)?
8 .95 agpl-1.0 affero general public license version 1(?: 0)?
7 .92 agpl-3.0 agplv3
7 .92 agpl-3.0 agpl(?: version)? 3(?: 0)?
6 .88 agpl gnu affero general public license
6 .88 agpl affero general public license
5 .75 agpl agpl license
9 .99 gfdl gnu org licenses fdl(?: html| txt)?
8 .95 gfdl-1.3 gnu free documentation license version 1 3
8 .95 gfdl-1.2 gnu free documentation license version 1 2
6 .88 gfdl gnu free documentation license
6 .80 gfdl free documentation license
9 .99 bsd-3-clause opensource org licenses bsd 3 clause
9 .99 bsd-2-clause opensource org licenses bsd 2 clause
9 .90 bsd opensource org licenses bsd license(?: php)?
7 .95 bsd-3-clause bsd 3 clause(?: license)?
7 .95 bsd-2-clause bsd 2 clause(?: license)?
7 .95 bsd-4-clause bsd 4 clause(?: license)?
7 .95 bsd-3-clause 3 clause bsd(?: license)?
7 .95 bsd-2-clause 2 clause bsd(?: license)?
7 .95 bsd-4-clause 4 clause bsd(?: license)?
7 .93 bsd-3-clause (?:new|modified|revised) bsd license
7 .93 bsd-2-clause simplified bsd license
7 .93 bsd-2-clause freebsd license
7 .93 bsd-4-clause original bsd license
7 .95 0bsd zero clause bsd(?: license)?
5 .85 bsd the bsd license
5 .80 bsd bsd license
5 .80 bsd bsd licence
5 .70 bsd bsd licensed
1 .40 bsd bsd style license
3 .80 bsd redistribution and use in source and binary forms with or without modification are permitted
3 .75 bsd redistributions of source code must retain the above copyright notice
3 .75 bsd redistributions in binary form must reproduce the above copyright notice
3 .80 bsd-3-clause neither the name of(?: the)?(?: copyright holder| author| university)? nor the names of its contributors may be used to endorse
3 .80 bsd-4-clause all advertising materials mentioning features or use of this software must display
9 .99 isc opensource org licenses isc(?: license)?
5 .88 isc isc license
5 .88 isc internet systems consortium license
3 .75 isc permission to use copy modify and or distribute this software for any purpose with or without fee
9 .99 mpl-2.0 mozilla org mpl 2 0
9 .99 mpl-1.1 mozilla org mpl mpl 1 1(?: html)?
7 .97 mpl-2.0 mozilla public license(?: mpl)?(?: version| v)? 2(?: 0)?
7 .97 mpl-1.1 mozilla public license(?: mpl)?(?: version| v)? 1 1
7 .92 mpl-2.0 mpl(?: version)? 2 0
7 .92 mpl-1.1 mpl(?: version)? 1 1
5 .88 mpl mozilla public license
5 .70 mpl mpl license
3 .80 mpl-2.0 this source code form is subject to the terms of the mozilla public license
9 .99 epl-2.0 eclipse org legal epl(?: 2 0| v20)(?: html)?
9 .99 epl-1.0 eclipse org legal epl v10(?: html)?
7 .97 epl-2.0 eclipse public license(?: version| v)? 2(?: 0)?
7 .97 epl-1.0 eclipse public license(?: version| v)? 1(?: 0)?
7 .90 edl-1.0 eclipse distribution license(?: version| v)? 1(?: 0)?
5 .88 epl eclipse public license
5 .85 edl eclipse distribution license
7 .95 cddl-1.0 common development and distribution license(?: cddl)?(?: version| v)? 1(?: 0)?
7 .95 cddl-1.1 common development and distribution license(?: cddl)?(?: version| v)? 1 1
5 .88 cddl common development and distribution license
5 .70 cddl cddl license
7 .95 cpl-1.0 common public license(?: version| v)? 1(?: 0)?
5 .85 cpl common public license
9 .99 cc0-1.0 creativecommons org publicdomain zero 1 0
9 .99 cc-pdm creativecommons org publicdomain mark 1 0
9 .99 cc-by-4.0 creativecommons org licenses by 4 0
9 .99 cc-by-3.0 creativecommons org licenses by 3 0
9 .99 cc-by-sa-4.0 creativecommons org licenses by sa 4 0
9 .99 cc-by-sa-3.0 creativecommons org licenses by sa 3 0
9 .99 cc-by-nc-4.0 creativecommons org licenses by nc 4 0
9 .99 cc-by-nc-3.0 creativecommons org licenses by nc 3 0
9 .99 cc-by-nd-4.0 creativecommons org licenses by nd 4 0
9 .99 cc-by-nc-sa-4.0 creativecommons org licenses by nc sa 4 0
9 .99 cc-by-nc-sa-3.0 creativecommons org licenses by nc sa 3 0
9 .99 cc-by-nc-nd-4.0 creativecommons org licenses by nc nd 4 0
9 .99 cc-by-nc-nd-3.0 creativecommons org licenses by nc nd 3 0
8 .96 cc-by-nc-nd-4.0 cc by nc nd 4 0
8 .96 cc-by-nc-sa-4.0 cc by nc sa 4 0
8 .96 cc-by-nc-4.0 cc by nc 4 0
8 .96 cc-by-nd-4.0 cc by nd 4 0
8 .96 cc-by-sa-4.0 cc by sa 4 0
8 .96 cc-by-sa-3.0 cc by sa 3 0
8 .96 cc-by-4.0 cc by 4 0
8 .96 cc-by-3.0 cc by 3 0
8 .95 cc0-1.0 cc0 1 0(?: universal)?
8 .96 cc-by-nc-nd-4.0 creative commons attribution noncommercial noderiv(?:s|atives) 4 0
8 .96 cc-by-nc-sa-4.0 creative commons attribution noncommercial sharealike 4 0
8 .96 cc-by-nc-4.0 creative commons attribution non ?commercial 4 0
8 .96 cc-by-nd-4.0 creative commons attribution noderiv(?:s|atives) 4 0
8 .96 cc-by-sa-4.0 creative commons attribution share ?alike 4 0
8 .96 cc-by-sa-3.0 creative commons attribution share ?alike 3 0
8 .96 cc-by-4.0 creative commons attribution 4 0
8 .96 cc-by-3.0 creative commons attribution 3 0
6 .85 cc-by-nc-nd cc by nc nd
6 .85 cc-by-nc-sa cc by nc sa
6 .85 cc-by-nc cc by nc
6 .85 cc-by-nd cc by nd
6 .85 cc-by-sa cc by sa
5 .80 cc-by cc by
6 .85 cc-by-sa creative commons attribution share ?alike
6 .85 cc-by-nc creative commons attribution non ?commercial
5 .80 cc-by creative commons attribution
5 .80 cc0 cc0
5 .80 cc0 creative commons zero
5 .60 cc creative commons license
5 .60 cc creative commons licence
5 .60 cc licensed under(?: a)? creative commons
1 .40 cc creative commons
9 .99 unlicense unlicense org
5 .85 unlicense the unlicense
3 .80 unlicense this is free and unencumbered software released into the public domain
3 .60 public-domain released into the public domain
3 .60 public-domain dedicated to the public domain
3 .60 public-domain placed in the public domain
3 .55 public-domain this work is in the public domain
1 .40 public-domain public domain
9 .95 wtfpl wtfpl net
7 .95 wtfpl do what the fuck you want to public license
5 .80 wtfpl wtfpl
9 .99 zlib opensource org licenses zlib
7 .90 zlib zlib libpng license
5 .85 zlib zlib license
5 .80 libpng libpng license
3 .75 zlib this software is provided as is without any express or implied warranty in no event will the authors
9 .99 bsl-1.0 boost org license 1 0(?: txt)?
7 .95 bsl-1.0 boost software license(?: version| v)? 1(?: 0)?
5 .88 bsl-1.0 boost software license
7 .95 artistic-2.0 artistic license(?: version)? 2(?: 0)?
7 .95 artistic-1.0 artistic license(?: version)? 1(?: 0)?
5 .85 artistic artistic license
5 .85 perl same terms as perl itself
9 .99 ofl-1.1 scripts sil org ofl
7 .95 ofl-1.1 sil open font license(?: version| v)? 1 1
5 .88 ofl sil open font license
5 .80 ofl open font license
5 .85 postgresql postgresql license
7 .92 python-2.0 python software foundation license version 2
5 .88 psf python software foundation license
5 .75 psf psf license
5 .85 ncsa university of illinois ncsa open source license
5 .80 ncsa ncsa open source license
7 .95 eupl-1.2 european union public licen[cs]e(?: version| v)? 1 2
7 .95 eupl-1.1 european union public licen[cs]e(?: version| v)? 1 1
5 .88 eupl european union public licen[cs]e
5 .70 eupl eupl
5 .88 ms-pl microsoft public license
5 .88 ms-rl microsoft reciprocal license
5 .85 ms-eula microsoft software license terms
9 .99 odbl-1.0 opendatacommons org licenses odbl
9 .99 odc-by-1.0 opendatacommons org licenses by
9 .99 pddl-1.0 opendatacommons org licenses pddl
5 .88 odbl open database license
5 .88 odc-by open data commons attribution license
5 .88 pddl public domain dedication and license
7 .95 mulanpsl-2.0 mulan psl v2
5 .88 mulanpsl mulan permissive software license
7 .92 upl-1.0 universal permissive license(?: version| v)? 1(?: 0)?
5 .85 upl universal permissive license
5 .85 ecl educational community license
5 .85 afl academic free license
5 .85 osl open software license
5 .85 cecill cecill(?: free software)? license
5 .85 nasa nasa open source agreement
5 .85 openssl openssl license
5 .80 ssleay original ssleay license
5 .80 ruby ruby license
5 .80 php php license
5 .80 vim vim license
5 .85 w3c w3c software notice and license
5 .80 w3c w3c license
5 .85 x11 x11 license
5 .80 xfree86 xfree86 license
5 .80 tcl tcl tk license
5 .80 curl curl license
5 .80 icu icu license
5 .80 unicode unicode license
5 .85 ijg independent jpeg group license
5 .80 freetype freetype(?: project)? license
5 .80 imagemagick imagemagick license
5 .85 qpl q public license
5 .85 sleepycat sleepycat license
5 .85 intel intel open source license
5 .85 ipl ibm public license
5 .85 lppl latex project public license
5 .85 zpl zope public license
5 .85 rpl reciprocal public license
5 .85 cpal common public attribution license
5 .85 apsl apple public source license
5 .85 nokia nokia open source license
5 .85 sun sun industry standards source license
5 .85 spl sun public license
5 .85 watcom sybase open watcom public license
5 .85 beerware beerware
3 .70 beerware if we meet some day and you think this stuff is worth it you can buy me a beer
7 .92 busl-1.1 business source license(?: version)? 1 1
5 .88 busl business source license
7 .92 sspl-1.0 server side public license(?: version| v)? 1
5 .88 sspl server side public license
7 .92 elastic-2.0 elastic license(?: version)? 2(?: 0)?
5 .85 elastic elastic license
5 .85 confluent confluent community license
5 .85 commons-clause commons clause
5 .85 polyform polyform(?: noncommercial| shield| strict)? license
5 .85 openrail openrail(?: m)? license
5 .85 llama llama 2 community license
5 .80 llama llama(?: 3)? community license
5 .85 rail responsible ai license
3 .60 proprietary all rights reserved
3 .65 proprietary unauthorized copying of this file
3 .65 proprietary proprietary and confidential
3 .60 proprietary may not be reproduced without(?: the)?(?: prior)? written permission
3 .60 proprietary no part of this(?: work| publication| document)? may be reproduced
3 .60 proprietary strictly confidential
3 .60 eula end user license agreement
3 .60 eula by installing or using(?: this| the) software you agree
1 .40 eula terms of service
1 .40 eula terms of use
1 .35 free-software free software foundation
1 .35 free-software open source license
1 .35 free-software open source software
1 .30 unknown licensed under
1 .30 unknown under the terms of the license
1 .25 unknown see the license file
1 .25 unknown license agreement
1 .20 unknown copyright c
1 .20 unknown copyright notice
1 .20 unknown permission is granted
"""


class Rule(NamedTuple):
    label: str
    priority: int
    confidence: float
    keyword: bytes
    pattern: re.Pattern[bytes]


def _keyword(pattern: str) -> bytes:
    """The longest text that every match has: outside of groups, classes and what a quantifier follows."""
    plain = re.sub(r"\(\?:[^()]*\)\??|\[[^\]]*\]|.\?", "\0", pattern)
    return max(plain.split("\0"), key=len).strip().encode()


def _rule(priority: str, confidence: str, label: str, pattern: str) -> Rule:
    return Rule(label, int(priority), float(confidence), _keyword(pattern), re.compile(rb"(?<= )" + pattern.encode() + rb"(?= )"))


def rules() -> list[Rule]:
    """All rules, those of higher priority first."""
    found = [_rule(*line.split(" ", 3)) for line in RULES.strip().splitlines()]
    for entry in re.split(r"\s{2,}|\n", IDENTIFIERS.strip()):
        words, label = entry.split("=")
        found.append(_rule("9", ".99", label, f"spdx license identifier {words}(?: only)?"))
        found.append(_rule("9", ".99", f"{label}-or-later", f"spdx license identifier {words} or later"))
    return sorted(found, key=lambda r: -r.priority)
