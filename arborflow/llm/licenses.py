"""License mentions in texts: ordered signature rules behind a keyword prefilter.

A rule is a regular expression over lower-cased words parted by single spaces. It starts at its anchor, a literal
word, and names a keyword that must also be near. A text without any anchor is done after one search; at each
anchor word only that anchor's rules are tried, and of them only those whose keyword stands in the next words.
Overlaps are settled by priority and containment: a find inside another's interval goes if its priority is no
higher; finds of equal interval leave the first in order of priority and label.

About 600 rules are written down: names, titles and SPDX identifiers of licenses, sentences of their texts and usual
headers. Names, titles and identifiers are also looked for behind each of five leads, which changes priority and weight.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborflow.llm.columns import item_words, let, spaces

#: phrase and label; their places are counted
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: keyword, label, name as it is written: every name is also looked for behind each lead below
NAMES = [
    ("mit", "mit", r"mit(?: x11)? license"),
    ("expat", "mit", r"expat license"),
    ("apache", "apache-2.0", r"apache (?:software )?license(?: version)? 2(?: 0)?"),
    ("apache", "apache-1.1", r"apache (?:software )?license(?: version)? 1 1"),
    ("apache", "apache", r"apache(?: software)? license"),
    ("bsd", "bsd-2-clause", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: license)?"),
    ("bsd", "bsd-3-clause", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd)(?: license)?"),
    ("bsd", "bsd-4-clause", r"(?:bsd 4 clause|4 clause bsd|original bsd)(?: license)?"),
    ("bsd", "0bsd", r"(?:zero clause bsd|bsd zero clause|0bsd|0 bsd)(?: license)?"),
    ("bsd", "bsd", r"bsd(?: style)? license"),
    ("affero", "agpl-3.0", r"(?:gnu )?affero general public license(?: version| v)? ?3(?: 0)?"),
    ("affero", "agpl", r"(?:gnu )?affero general public license"),
    ("agpl", "agpl", r"(?:gnu )?agpl(?: ?v?[13](?: 0)?)?"),
    ("lesser", "lgpl-2.1", r"(?:gnu )?lesser general public license(?: version| v)? ?2 1"),
    ("lesser", "lgpl-3.0", r"(?:gnu )?lesser general public license(?: version| v)? ?3(?: 0)?"),
    ("lesser", "lgpl", r"(?:gnu )?lesser general public license"),
    ("library", "lgpl-2.0", r"(?:gnu )?library general public license"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl(?: ?v?[23](?: [01])?)?"),
    ("general", "gpl-2.0", r"(?:gnu )?general public license(?: version| v)? ?2(?: 0)?"),
    ("general", "gpl-3.0", r"(?:gnu )?general public license(?: version| v)? ?3(?: 0)?"),
    ("general", "gpl", r"gnu general public license"),
    ("gpl", "gpl-2.0", r"(?:gnu )?gpl ?v?2(?: 0)?"),
    ("gpl", "gpl-3.0", r"(?:gnu )?gpl ?v?3(?: 0)?"),
    ("gpl", "gpl", r"(?:gnu )?gpl"),
    ("fdl", "gfdl", r"(?:gnu )?fdl(?: 1 [1-3])?"),
    ("documentation", "gfdl", r"(?:gnu )?free documentation license"),
    ("mozilla", "mpl-2.0", r"mozilla public license(?: version| v)? ?2(?: 0)?"),
    ("mozilla", "mpl-1.1", r"mozilla public license(?: version| v)? ?1 1"),
    ("mozilla", "mpl", r"mozilla public license"),
    ("mpl", "mpl", r"mpl(?: v?[12] [01])?"),
    ("eclipse", "epl-1.0", r"eclipse public license(?: version| v)? ?1(?: 0)?"),
    ("eclipse", "epl-2.0", r"eclipse public license(?: version| v)? ?2(?: 0)?"),
    ("eclipse", "epl", r"eclipse public license"),
    ("eclipse", "edl", r"eclipse distribution license"),
    ("isc", "isc", r"isc license"),
    ("zlib", "zlib", r"zlib(?: libpng)? license"),
    ("boost", "bsl-1.0", r"boost software license"),
    ("business", "busl-1.1", r"business source license"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("artistic", "artistic-2.0", r"artistic license 2(?: 0)?"),
    ("artistic", "artistic", r"(?:perl )?artistic license"),
    ("european", "eupl", r"european union public licen[cs]e"),
    ("eupl", "eupl", r"eupl(?: v?1 [0-2])?"),
    ("common", "cpl-1.0", r"common public license"),
    ("cddl", "cddl", r"cddl(?: 1 [01])?"),
    ("development", "cddl", r"common development and distribution license"),
    ("microsoft", "ms-pl", r"microsoft public license"),
    ("microsoft", "ms-rl", r"microsoft reciprocal license"),
    ("python", "psf-2.0", r"python(?: software foundation)? license"),
    ("php", "php", r"php license"),
    ("ruby", "ruby", r"ruby license"),
    ("postgresql", "postgresql", r"postgresql license"),
    ("openssl", "openssl", r"openssl license"),
    ("academic", "afl-3.0", r"academic free license"),
    ("open", "osl-3.0", r"open software license"),
    ("open", "ogl", r"open government licen[cs]e"),
    ("ofl", "ofl-1.1", r"(?:sil )?ofl(?: 1 1)?"),
    ("font", "ofl-1.1", r"(?:sil )?open font license"),
    ("odbl", "odbl", r"odbl"),
    ("database", "odbl", r"open database license"),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("zero", "cc0", r"creative commons zero"),
    ("cc", "cc-by-nc-nd", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc", "cc-by-nc-sa", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc", "cc-by-nc", r"cc by nc(?: [1-4] [05])?"),
    ("cc", "cc-by-nd", r"cc by nd(?: [1-4] [05])?"),
    ("cc", "cc-by-sa", r"cc by sa(?: [1-4] [05])?"),
    ("cc", "cc-by", r"cc by(?: [1-4] [05])?"),
    ("commons", "cc-by-nc-nd", r"creative commons attribution non ?commercial no ?derivatives"),
    ("commons", "cc-by-nc-sa", r"creative commons attribution non ?commercial share ?alike"),
    ("commons", "cc-by-sa", r"creative commons attribution share ?alike"),
    ("attribution", "cc-by-nc", r"creative commons attribution non ?commercial"),
    ("attribution", "cc-by", r"creative commons attribution"),
    ("creative", "creative-commons", r"creative commons(?: licen[cs]e)?"),
]

#: fixed values: label | title of a license, as words
TITLES = """
aal | attribution assurance license
afl-1.1 | academic free license(?: version | v ?| )1 1
afl-1.2 | academic free license(?: version | v ?| )1 2
afl-2.0 | academic free license(?: version | v ?| )2 0
afl-2.1 | academic free license(?: version | v ?| )2 1
agpl-1.0 | affero general public license(?: version | v ?| )1(?: 0)?
apsl-1.1 | apple public source license(?: version | v ?| )1 1
apsl-1.2 | apple public source license(?: version | v ?| )1 2
apsl-2.0 | apple public source license(?: version | v ?| )2(?: 0)?
apsl | apple public source license
artistic-1.0 | artistic license 1(?: 0)?
artistic | clarified artistic license
beerware | (?:beer ware|beerware) license
bittorrent | bittorrent open source license
blueoak-1.0.0 | blue oak model license(?: 1 0 0)?
bsd-1-clause | bsd 1 clause license
bsd-3-clause-clear | (?:bsd 3 clause )?clear bsd license
bsd-4-clause-uc | bsd 4 clause university of california specific
bsd-patent | bsd 2 clause plus patent(?: license)?
busl-1.1 | business source license 1 1
cal-1.0 | cryptographic autonomy license(?: 1 0)?
catosl-1.1 | computer associates trusted open source license(?: 1 1)?
cc-by-1.0 | creative commons attribution 1 0(?: generic)?
cc-by-2.0 | creative commons attribution 2 0(?: generic)?
cc-by-2.5 | creative commons attribution 2 5(?: generic)?
cc-by-3.0 | creative commons attribution 3 0(?: unported)?
cc-by-4.0 | creative commons attribution 4 0(?: international)?
cc-by-sa-3.0 | creative commons attribution share ?alike 3 0(?: unported)?
cc-by-sa-4.0 | creative commons attribution share ?alike 4 0(?: international)?
cc-pddc | creative commons public domain dedication(?: and certification)?
cdla-permissive-1.0 | community data license agreement permissive 1 0
cdla-permissive-2.0 | community data license agreement permissive 2 0
cdla-sharing-1.0 | community data license agreement sharing 1 0
cddl-1.0 | common development and distribution license(?: cddl)?(?: version | v ?| )1 0
cddl-1.1 | common development and distribution license(?: cddl)?(?: version | v ?| )1 1
cecill-1.0 | cecill free software license agreement(?: v ?| )1 0
cecill-2.0 | cecill free software license agreement(?: v ?| )2 0
cecill-2.1 | cecill free software license agreement(?: v ?| )2 1
cecill-b | cecill b free software license agreement
cecill-c | cecill c free software license agreement
cern-ohl-p-2.0 | cern open hardware licence version 2 permissive
cern-ohl-s-2.0 | cern open hardware licence version 2 strongly reciprocal
cern-ohl-w-2.0 | cern open hardware licence version 2 weakly reciprocal
cern-ohl | cern open hardware licen[cs]e
clartistic | clarified artistic licence
cnri-python | cnri python license
commons-clause | commons clause license condition
condor-1.1 | condor public license
cpal-1.0 | common public attribution license
cpl-1.0 | common public license(?: version | v ?| )1 0
cpol-1.02 | code project open license
cua-opl-1.0 | cua office public license
d-fsl-1.0 | deutsche freie software lizenz
docbook | docbook license
dtoa | david m gay dtoa license
ecl-1.0 | educational community license(?: version | v ?| )1(?: 0)?
ecl-2.0 | educational community license(?: version | v ?| )2(?: 0)?
ecos-2.0 | ecos license version 2 0
efl-2.0 | eiffel forum license(?: version | v ?| )2
efl-1.0 | eiffel forum license
elastic-2.0 | elastic license(?: version | v ?| )2(?: 0)?
elastic | elastic license
entessa | entessa public license
erlpl-1.1 | erlang public license
eudatagrid | eu datagrid software license
fair | fair license
frameworx-1.0 | frameworx open license
ftl | freetype (?:project )?license
gemma | gemma terms of use
gfdl-1.1 | free documentation license(?: version | v ?| )1 1
gfdl-1.2 | free documentation license(?: version | v ?| )1 2
gfdl-1.3 | free documentation license(?: version | v ?| )1 3
gpl-1.0 | general public license(?: version | v ?| )1(?: 0)?
gpl-cc | gpl cooperation commitment
gsoap-1.3b | gsoap public license
hippocratic-2.1 | hippocratic license(?: 2 1)?
hpnd | historical permission notice and disclaimer
ibm-ibmpl | ibm public license(?: version | v ?| )1 0
ibm-ibmpl | ibm public license
icu | icu license
ijg | independent jpeg group license
imagemagick | imagemagick license
imatix | imatix standard function library agreement
info-zip | info zip license
intel | intel open source license
interbase-1.0 | interbase public license
ipa | ipa font license
jasper-2.0 | jasper license
json | json license
lal-1.3 | licence art libre
lal-1.3 | free art license
latex2e | latex2e license
leptonica | leptonica license
lgpl-2.0 | library general public license(?: version | v ?| )2(?: 0)?
libpng-2.0 | png reference library(?: license)? version 2
libpng | libpng license
libtiff | libtiff license
liliq-p-1.1 | licence libre du quebec permissive
liliq-r-1.1 | licence libre du quebec reciprocite
llama-2 | llama 2 community license(?: agreement)?
llama-3 | (?:meta )?llama 3(?: [1-3])? community license(?: agreement)?
lpl-1.02 | lucent public license
lppl-1.3c | latex project public license(?: version | v ?| )1 3c?
lppl | latex project public license
mirosl | miros licen[cs]e
mit-0 | mit no attribution(?: license)?
mit-cmu | cmu license
mit-modern | modern variant of the mit license
motosoto | motosoto license
mpl-1.0 | mozilla public license(?: version | v ?| )1 0
ms-lpl | microsoft limited public license
mulanpsl-1.0 | mulan permissive software license(?: version | v ?| )1
mulanpsl-2.0 | mulan permissive software license(?: version | v ?| )2
multics | multics license
naist-2003 | nara institute of science and technology license
nasa-1.3 | nasa open source agreement(?: 1 3)?
naumen | naumen public license
nbpl-1.0 | net boolean public license
ncsa | university of illinois ncsa open source license
ncsa | ncsa open source license
ngpl | nethack general public license
nlod-2.0 | norwegian licence for open government data
nokia | nokia open source license
npl-1.1 | netscape public license
nposl-3.0 | non profit open software license
ntp | ntp license
o-uda-1.0 | open use of data agreement
oclc-2.0 | oclc research public license
odc-by-1.0 | open data commons attribution license
odc-pddl-1.0 | open data commons public domain dedication and license
odbl-1.0 | open data commons open database license
ogc-1.0 | ogc software license
ogl-uk-2.0 | open government licence(?: for public sector information)?(?: v ?| )2 0
ogl-uk-3.0 | open government licence(?: for public sector information)?(?: v ?| )3 0
ogtsl | open group test suite license
oldap-2.8 | openldap public license(?: version | v ?| )2 8
oldap | openldap public license
openrail-m | (?:bigscience |creativeml )?(?:open rail|openrail) (?:m )?license
opl-1.0 | open content license
opubl-1.0 | open publication license
oset-pl-2.1 | oset public license
osl-1.0 | open software license(?: version | v ?| )1 0
osl-2.0 | open software license(?: version | v ?| )2 0
osl-2.1 | open software license(?: version | v ?| )2 1
parity-7.0.0 | parity public license
php-3.0 | php license(?: version | v ?| )3 0
php-3.01 | php license(?: version | v ?| )3 01
polyform-noncommercial | polyform noncommercial license
polyform-shield | polyform shield license
polyform-small-business | polyform small business license
prosperity-3.0.0 | prosperity public license
qpl-1.0 | q public license
rhecos-1.1 | red hat ecos public license
rpl-1.1 | reciprocal public license(?: version | v ?| )1 1
rpl-1.5 | reciprocal public license(?: version | v ?| )1 5
rpl | reciprocal public license
rpsl-1.0 | realnetworks public source license
rscpl | ricoh source code public license
ruby | ruby s license
saxpath | saxpath license
sgi-b-2.0 | sgi free software license b
simpl-2.0 | simple public license
sissl | sun industry standards source license
sleepycat | sleepycat license
spl-1.0 | sun public license
sspl-1.0 | server side public license
sugarcrm-1.1.3 | sugarcrm public license
tcl | tcl tk license
tmate | tmate open source license
torque-1.1 | torque software license
ucl-1.0 | upstream compatibility license
unicode | unicode license(?: agreement)?(?: data files and software)?
upl-1.0 | universal permissive license
vim | vim license
vsl-1.0 | vovida software license
w3c | w3c software (?:and document )?(?:notice and )?license
watcom-1.0 | sybase open watcom public license
wxwindows | wxwindows library licen[cs]e
x11 | x11 license
xfree86-1.1 | xfree86 license
xinetd | xinetd license
xnet | x net license
ypl-1.1 | yahoo public license
zed | zed license
zend-2.0 | zend license
zimbra-1.3 | zimbra public license
zlib-acknowledgement | zlib libpng license with acknowledgement
zpl-2.0 | zope public license(?: version | v ?| )2 0
zpl-2.1 | zope public license(?: version | v ?| )2 1
zpl | zope public license
"""

#: fixed values: SPDX identifiers; without `-only` and `-or-later` they are the labels
IDENTIFIERS = """
0BSD AAL AFL-1.1 AFL-1.2 AFL-2.0 AFL-2.1 AFL-3.0 AGPL-1.0-only AGPL-1.0-or-later AGPL-3.0-only AGPL-3.0-or-later
Apache-1.0 Apache-1.1 Apache-2.0 APSL-1.0 APSL-1.1 APSL-1.2 APSL-2.0 Artistic-1.0 Artistic-2.0 Beerware BlueOak-1.0.0
BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-3-Clause-LBNL BSD-4-Clause
BSD-4-Clause-UC BSL-1.0 BUSL-1.1 CAL-1.0 CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-3.0 CC-BY-NC-4.0
CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0 CC-BY-ND-3.0 CC-BY-ND-4.0 CC-BY-SA-2.0 CC-BY-SA-2.5
CC-BY-SA-3.0 CC-BY-SA-4.0 CC-PDDC CC0-1.0 CDDL-1.0 CDDL-1.1 CDLA-Permissive-1.0 CDLA-Permissive-2.0 CDLA-Sharing-1.0
CECILL-1.0 CECILL-2.0 CECILL-2.1 CECILL-B CECILL-C CERN-OHL-P-2.0 CERN-OHL-S-2.0 CERN-OHL-W-2.0 ClArtistic CNRI-Python
CPAL-1.0 CPL-1.0 CPOL-1.02 curl ECL-1.0 ECL-2.0 EFL-2.0 Elastic-2.0 EPL-1.0 EPL-2.0 ErlPL-1.1 EUPL-1.0 EUPL-1.1 EUPL-1.2
FTL GFDL-1.1-only GFDL-1.2-only GFDL-1.3-only GFDL-1.3-or-later GPL-1.0-only GPL-1.0-or-later GPL-2.0-only
GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later HPND ICU IJG ImageMagick Intel IPA IPL-1.0 ISC JasPer-2.0 JSON LAL-1.3
LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later Libpng libtiff LiLiQ-P-1.1
LPL-1.02 LPPL-1.3c MirOS MIT MIT-0 MIT-CMU MIT-Modern-Variant MPL-1.0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-1.0
MulanPSL-2.0 NASA-1.3 NCSA NGPL NPL-1.1 NPOSL-3.0 NTP ODbL-1.0 ODC-By-1.0 OFL-1.0 OFL-1.1 OGL-UK-2.0 OGL-UK-3.0
OLDAP-2.8 OpenSSL OSL-1.0 OSL-2.0 OSL-2.1 OSL-3.0 Parity-7.0.0 PDDL-1.0 PHP-3.0 PHP-3.01 PostgreSQL PSF-2.0 Python-2.0
QPL-1.0 RPL-1.1 RPL-1.5 Ruby SGI-B-2.0 SISSL Sleepycat SPL-1.0 SSPL-1.0 TCL UCL-1.0 Unicode-DFS-2016 Unicode-3.0
Unlicense UPL-1.0 Vim W3C Watcom-1.0 WTFPL X11 XFree86-1.1 Xnet YPL-1.1 Zend-2.0 Zlib ZPL-2.0 ZPL-2.1
"""

#: identifiers that begin as a product with its version does: they count behind a lead only
VERSIONED = frozenset("elastic jasper nasa parity php python unicode watcom xfree86 zend".split())

#: fixed values: priority | weight | label | sentence of a license text or a usual header
TEXTS = r"""
0 | 1.0 | apache-2.0 | you may not use this file except in compliance with the license
0 | 1.0 | apache-2.0 | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
0 | 1.0 | apache-2.0 | grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license
0 | 0.9 | apache-2.0 | redistribution you may reproduce and distribute copies of the work or derivative works thereof
0 | 0.9 | apache-1.1 | this product includes software developed by the apache software foundation
0 | 1.0 | mit | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
0 | 0.9 | mit | to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense
1 | 0.7 | mit | in no event shall the authors or copyright holders be liable for any claim damages or other liability
0 | 0.9 | x11 | except as contained in this notice the name of (?:\S+ ){1,8}shall not be used in advertising
0 | 0.9 | bsd-2-clause | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
0 | 0.9 | bsd-2-clause | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
0 | 0.9 | bsd-4-clause | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
1 | 0.7 | bsd | this software is provided by the (?:\S+ ){1,8}as is and any express or implied warranties
1 | 0.7 | bsd | in no event shall the (?:\S+ ){1,8}be liable for any direct indirect incidental special exemplary or consequential damages
0 | 0.9 | bsd-patent | a perpetual worldwide non exclusive no charge royalty free irrevocable patent license
0 | 0.9 | bsd-3-clause-clear | no express or implied licenses to any party s patent rights are granted by this license
0 | 1.0 | gpl | you should have received a copy of the gnu general public license along with this program
0 | 1.0 | gpl | as published by the free software foundation either version (?:[123](?: 0)?) of the license or at your option any later version
0 | 0.9 | gpl-2.0 | either version 2 of the license or at your option any later version
0 | 0.9 | gpl-3.0 | either version 3 of the license or at your option any later version
0 | 0.9 | lgpl-2.1 | either version 2 1 of the license or at your option any later version
0 | 0.9 | gpl | everyone is permitted to copy and distribute verbatim copies of this license document
0 | 0.8 | gpl | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license
0 | 0.9 | gpl-3.0 | the gnu general public license is a free copyleft license for software and other kinds of works
0 | 0.9 | gpl-2.0 | the licenses for most software are designed to take away your freedom to share and change it
0 | 0.9 | gpl-classpath | as a special exception the copyright holders of this library give you permission to link this library
0 | 0.9 | gpl-bison | as a special exception you may create a larger work that contains part or all of the bison parser skeleton
0 | 0.9 | gpl-autoconf | as a special exception to the gnu general public license if you distribute this file as part of a program
0 | 0.9 | gpl-gcc | gcc runtime library exception
0 | 0.9 | gpl-font | font exception
0 | 0.9 | gpl-linux-syscall | this copyright does not cover user programs that use kernel services by normal system calls
0 | 1.0 | lgpl | you should have received a copy of the gnu lesser general public license along with this library
0 | 1.0 | lgpl-2.0 | you should have received a copy of the gnu library general public license
0 | 0.9 | lgpl-3.0 | this version of the gnu lesser general public license incorporates the terms and conditions of version 3
0 | 1.0 | agpl | you should have received a copy of the gnu affero general public license
0 | 0.9 | agpl-3.0 | your modified version must prominently offer all users interacting with it remotely through a computer network
0 | 1.0 | gfdl | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
0 | 0.9 | gfdl | with no invariant sections no front cover texts and no back cover texts
0 | 1.0 | mpl-2.0 | if a copy of the mpl was not distributed with this file you can obtain one at
0 | 1.0 | mpl-1.1 | the contents of this file are subject to the mozilla public license version 1 1
0 | 0.9 | mpl | the original code is (?:\S+ ){1,8}the initial developer of the original code is
0 | 0.9 | npl-1.1 | the contents of this file are subject to the netscape public license
0 | 1.0 | cddl | the contents of this file are subject to the terms of the common development and distribution license
0 | 0.9 | cddl | you can obtain a copy of the license at usr src opensolaris license
0 | 1.0 | epl-1.0 | this program and the accompanying materials are made available under the terms of the eclipse public license (?:v )?1 0
0 | 1.0 | epl-2.0 | this program and the accompanying materials are made available under the terms of the eclipse public license (?:v )?2 0
0 | 0.9 | epl | this program and the accompanying materials are made available under
0 | 0.9 | cpl-1.0 | any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement
0 | 1.0 | eupl | licensed under the eupl(?: version)?(?: 1 [0-2])? (?:only )?the licen[cs]e
0 | 1.0 | isc | permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted
0 | 1.0 | 0bsd | permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted the software is provided as is
0 | 0.9 | hpnd | permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted
0 | 0.9 | ntp | provided that the above copyright notice appears in all copies and that both (?:that )?(?:the )?copyright notice and this permission notice appear in supporting documentation
0 | 1.0 | zlib | this software is provided as is without any express or implied warranty in no event will the authors be held liable
0 | 0.9 | zlib | the origin of this software must not be misrepresented you must not claim that you wrote the original software
0 | 0.9 | zlib | this notice may not be removed or altered from any source distribution
0 | 1.0 | bsl-1.0 | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
0 | 1.0 | bsl-1.0 | distributed under the boost software license(?: version)?(?: 1 0)?
0 | 1.0 | unlicense | anyone is free to copy modify publish use compile sell or distribute this software
0 | 0.9 | unlicense | in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest
0 | 0.9 | wtfpl | you just do what the f\S* you want to
0 | 0.9 | beerware | as long as you retain this notice you can do whatever you want with this stuff
0 | 0.9 | beerware | you can buy me a beer in return
0 | 1.0 | cc0 | to the extent possible under law the (?:person|author|\S+) who associated cc0 with this
0 | 1.0 | cc0 | has waived all copyright and related or neighboring rights
0 | 0.9 | cc0 | no copyright the person who associated a work with this deed has dedicated the work to the public domain
0 | 0.9 | cc-by | you must give appropriate credit provide a link to the license and indicate if changes were made
0 | 0.9 | cc-by-sa | if you remix transform or build upon the material you must distribute your contributions under the same license
0 | 0.9 | cc-by-nc | you may not use the material for commercial purposes
0 | 0.9 | cc-by-nd | if you remix transform or build upon the material you may not distribute the modified material
0 | 0.9 | creative-commons | this work is licensed under a creative commons
0 | 0.8 | creative-commons | to view a copy of this license visit (?:https? )?(?:www )?creativecommons org
0 | 0.9 | ofl-1.1 | this font software is licensed under the sil open font license
0 | 0.9 | ofl-1.1 | neither the font software nor any of its individual components in original or modified versions may be sold by itself
0 | 0.9 | odbl | this database is made available under the open database license
0 | 0.9 | odbl | any rights in individual contents of the database are licensed under the database contents license
0 | 0.9 | ogl | contains public sector information licensed under the open government licen[cs]e
0 | 0.9 | artistic | the intent of this document is to state the conditions under which a package may be copied
0 | 0.9 | artistic | same terms as perl itself
0 | 0.9 | artistic-2.0 | this license establishes the terms under which a given free software package may be copied modified distributed
0 | 0.9 | psf-2.0 | psf is making python available to licensee on an as is basis
0 | 0.9 | php | this product includes php software freely available from
0 | 0.9 | openssl | this product includes software developed by the openssl project
0 | 0.9 | openssl | this product includes cryptographic software written by eric young
0 | 0.9 | ms-pl | if you use the software you accept this license if you do not accept the license do not use the software
0 | 0.9 | w3c | this work is being provided by the copyright holders under the following license
0 | 0.9 | unicode | permission is hereby granted free of charge to any person obtaining a copy of the unicode data files
0 | 0.9 | ncsa | permission is hereby granted free of charge to any person obtaining a copy of this software (?:\S+ ){1,4}to deal with the software without restriction
0 | 0.9 | json | the software shall be used for good not evil
0 | 0.9 | ftl | portions of this software are copyright (?:\S+ ){1,6}the freetype project
0 | 0.9 | ijg | this software is based in part on the work of the independent jpeg group
0 | 0.9 | sleepycat | redistributions in any form must be accompanied by information on how to obtain complete source code
0 | 0.9 | sspl-1.0 | if you make the functionality of the program or a modified version available to third parties as a service
0 | 0.9 | elastic-2.0 | you may not provide the software to third parties as a hosted or managed service
0 | 0.9 | commons-clause | the grant of rights under the license will not include and the license does not grant to you the right to sell the software
0 | 0.9 | busl-1.1 | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use
0 | 0.9 | openrail-m | you agree not to use the model or derivatives of the model
0 | 0.9 | upl-1.0 | subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software
0 | 0.9 | mulanpsl-2.0 | you can use this software according to the terms and conditions of the mulan psl
0 | 0.9 | cecill | this software is governed by the cecill(?: [bc])? license
0 | 0.9 | lppl | this work may be distributed and or modified under the conditions of the latex project public license
0 | 0.9 | lppl | this work has the lppl maintenance status
0 | 0.9 | tcl | the authors hereby grant permission to use copy modify distribute and license this software and its documentation for any purpose
0 | 0.9 | vim | vim is charityware
0 | 0.9 | curl | copyright (?:\S+ ){1,6}daniel stenberg
0 | 0.9 | fair | usage of the works is permitted provided that this instrument is retained with the works
0 | 0.9 | public-domain | this (?:file|software|work|code) is (?:hereby )?(?:released|placed|in|into) (?:in |into )?the public domain
0 | 0.9 | public-domain | the author disclaims copyright to this source code
0 | 0.9 | public-domain | this work was prepared by an officer or employee of the united states government
1 | 0.7 | no-warranty | the software is provided as is without warranty of any kind
1 | 0.6 | no-warranty | use at your own risk
1 | 0.7 | proprietary | this software is the confidential and proprietary information of
1 | 0.7 | proprietary | unpublished rights reserved under the copyright laws
1 | 0.7 | proprietary | for internal use only
1 | 0.7 | proprietary | end user license agreement
1 | 0.7 | proprietary | no part of this (?:publication|book|work|document) may be reproduced
1 | 0.7 | proprietary | reproduction in whole or in part without (?:written )?permission is prohibited
1 | 0.6 | noncommercial | free for (?:personal|private|academic|noncommercial|non commercial) use(?: only)?
1 | 0.6 | noncommercial | for (?:noncommercial|non commercial) (?:use|purposes) only
1 | 0.6 | reserved | some rights reserved
1 | 0.6 | reserved | tous les droits sont reserves
1 | 0.6 | reserved | diritti riservati
1 | 0.6 | reserved | reservados todos los derechos
2 | 0.4 | unnamed-license | this file is part of
2 | 0.4 | unnamed-license | see the file (?:copying|license|licence|notice)
2 | 0.4 | unnamed-license | for the full copyright and license information please view the license file
2 | 0.4 | unnamed-license | dual licensed under
2 | 0.4 | unnamed-license | triple licensed under
"""


def _fields(stated: str) -> list:
    return [[field.strip() for field in line.split("|", count)] for line in stated.strip().splitlines() for count in [3 if line[0].isdigit() and line[1] == " " else 1]]


def _needed(pattern: str) -> str:
    """The longest word that every spelling of a pattern holds."""
    flat = pattern
    while "(?:" in flat:
        flat = re.sub(r"\(\?:[^()]*\)(?:\{\d,\d\})?\??", " ", flat)
    return max((w for w in flat.split() if w.isalnum()), key=len)


def _titles() -> list:
    return [(_needed(pattern), label, pattern) for label, pattern in _fields(TITLES)]


def _identifiers() -> list:
    """keyword, label and words of each SPDX identifier; a name that is a word of its own counts behind a lead only."""
    out = []
    for name in IDENTIFIERS.split():
        words = re.sub(r"[^a-z0-9]+", " ", name.lower())
        out.append((max(words.split(), key=len), re.sub("-(?:only|or-later)$", "", name.lower()), words))
    return out


def _texts() -> list:
    return [(int(priority), float(weight), _needed(sentence), label, sentence) for priority, weight, label, sentence in _fields(TEXTS)]


#: priority (0 first), weight, words before a name
LEADS = [
    (0, 0.95, r"(?:licensed|licenced) (?:to you )?(?:under|by|according to) (?:the )?(?:terms (?:and conditions )?of )?(?:the |a |an )?"),
    (0, 0.95, r"(?:released|distributed|available|published|provided|covered|made available) (?:freely )?(?:under|by) (?:the )?(?:terms (?:and conditions )?of )?(?:the |a |an )?"),
    (0, 0.9, r"spdx license identifier (?:is )?"),
    (0, 0.9, r"(?:license|licence|lizenz|licencia|licences) (?:is |the |type )?(?:the )?"),
    (1, 0.8, r"(?:under|sous|unter|bajo) (?:the |la |licence |licencia |der )?(?:terms of )?(?:the )?"),
]

#: priority, weight, keyword, label, sentence
SENTENCES = [
    (0, 1.0, "granted", "mit", r"permission is hereby granted free of charge to any person obtaining a copy"),
    (0, 1.0, "fee", "isc", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee"),
    (0, 1.0, "redistribution", "bsd", r"redistribution and use in source and binary forms with or without modification"),
    (0, 0.9, "endorse", "bsd-3-clause", r"neither the name of (?:\S+ ){1,8}may be used to endorse or promote products"),
    (0, 1.0, "compliance", "apache-2.0", r"except in compliance with the license"),
    (0, 1.0, "redistribute", "gpl", r"program is free software you can redistribute it and or modify"),
    (0, 1.0, "redistribute", "lgpl", r"library is free software you can redistribute it and or modify"),
    (0, 1.0, "mozilla", "mpl-2.0", r"source code form is subject to the terms of the mozilla public license"),
    (0, 1.0, "unencumbered", "unlicense", r"free and unencumbered software released into the public domain"),
    (0, 0.9, "altered", "zlib", r"altered source versions must be plainly marked as such"),
    (0, 0.9, "want", "wtfpl", r"do what the f\S* you want to public license"),
    (0, 0.8, "domain", "public-domain", r"(?:released|dedicated|placed|put) (?:in|to|into) the public domain"),
    (1, 0.6, "domain", "public-domain", r"public domain"),
    (1, 0.7, "warranty", "no-warranty", r"without (?:any )?warranty of any kind"),
    (1, 0.7, "warranty", "no-warranty", r"without any warranty"),
    (1, 0.6, "as", "no-warranty", r"provided as is"),
    (1, 0.7, "rights", "reserved", r"all rights reserved"),
    (1, 0.7, "derechos", "reserved", r"todos los derechos reservados"),
    (1, 0.7, "droits", "reserved", r"tous droits r\S+s"),
    (1, 0.7, "rechte", "reserved", r"alle rechte vorbehalten"),
    (1, 0.6, "confidential", "proprietary", r"proprietary and confidential"),
    (1, 0.6, "confidential", "proprietary", r"confidential and proprietary"),
    (1, 0.6, "copying", "proprietary", r"unauthorized copying of this file"),
    (2, 0.5, "copyright", "copyright", r"copyright (?:c |by )?(?:19|20)\d\d"),
    (2, 0.4, "under", "unnamed-license", r"(?:licensed|licenced) under"),
    (2, 0.4, "license", "unnamed-license", r"see (?:the )?license(?: file)?"),
]
GLUED = ("agpl", "bsd", "gpl", "lgpl")  # keywords that also stand inside a word: gplv3, freebsd
WINDOW = 32  # words from the anchor that a rule may see; no rule needs more


def _heads(pattern: str) -> list:
    """The words that a pattern can start with, each with the rest: an alternation in front is opened.

    A version that may follow its name without a space (gplv2, gpl2) makes further words.
    """
    start = re.match(r"\(\?:([a-z0-9| ]+)\)(\??)(.*)$", pattern)
    if not start:
        word, _, rest = pattern.partition(" ")
        plain = re.match(r"[a-z0-9]+", word)
        glued = re.match(r"(?:\(\?:)? \?v\?\[?(\d+)", pattern[len(plain[0]) :])
        return [(plain[0] + end, pattern) for end in ("", *[v + digit for digit in (glued[1] if glued else "") for v in ("", "v")])]
    heads = [head for word in start[1].split("|") for head in _heads(word + start[3])]
    return heads + (_heads(start[3]) if start[2] else [])


def rules() -> dict:
    """anchor: its rules as (keyword, expression, label, priority, weight)."""
    found: dict = {}
    names, identifiers = [*_titles(), *NAMES], _identifiers()
    stated = [*SENTENCES, *_texts()]
    stated += [(1, 0.7, keyword, label, name) for keyword, label, name in names]
    stated += [(1, 0.7, keyword, label, name) for keyword, label, name in identifiers if " " in name and name.split()[0] not in VERSIONED]
    stated += [(p, w, keyword, label, lead + name) for p, w, lead in LEADS for keyword, label, name in names]
    stated += [(p, w, keyword, label, lead + name) for p, w, lead in LEADS[:4] for keyword, label, name in identifiers]
    for priority, weight, keyword, label, pattern in stated:
        for anchor, opened in _heads(pattern):
            found.setdefault(anchor, []).append((keyword, f"^{opened}(?= )", label, priority, weight))
    return found


def _keyword(word: str) -> str:
    """What a window of words between spaces has to contain."""
    return word if word in GLUED else f" {word} "


def _rule_map() -> Column:
    """The rules as one constant."""
    stated = {a: [dict(zip(("keyword", "pattern", "label", "priority", "weight"), (_keyword(r[0]), *r[1:]))) for r in own] for a, own in rules().items()}
    return F.from_json(F.lit(json.dumps(stated)), "map<string,array<struct<keyword:string,pattern:string,label:string,priority:int,weight:double>>>")


def _finds(words: Column, rule_map: Column) -> Column:
    """start, -end, priority, label and weight of every rule's find, ordered so that what contains comes first."""
    empty = F.array().cast("array<struct<start:int,until:int,priority:int,label:string,weight:double>>")
    anchors = sorted(rules())

    def at(i):
        window = F.concat(F.lit(" "), F.array_join(F.slice(words, i + 1, WINDOW), " "), F.lit(" "))

        def of(window):
            near = F.filter(rule_map[F.get(words, i)], lambda r: F.contains(window, r["keyword"]))
            inner = F.substr(window, F.lit(2))
            finds = F.transform(near, lambda r: let(
                F.call_function("regexp_extract", inner, r["pattern"], F.lit(0)),
                lambda found: F.struct(i.alias("start"), F.when(found != "", -(i + spaces(found) + 1)).otherwise(0).alias("until"), r["priority"].alias("priority"), r["label"].alias("label"), r["weight"].alias("weight")),
            ))
            return F.filter(finds, lambda f: f["until"] < 0)

        return let(window, of)

    places = F.filter(F.transform(words, lambda w, i: F.when(w.isin(anchors), i)), lambda i: i.isNotNull())
    return F.array_sort(F.flatten(F.coalesce(F.transform(places, at), F.array(empty))))


def _kept(finds: Column) -> Column:
    """Labels and best weight of the finds that no find of at least their priority contains."""
    levels = sorted({p for own in rules().values() for *_, p, _ in own})
    start = F.struct(F.array(*[F.lit(0) for _ in levels]).alias("ends"), F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"), F.lit(0).alias("n"))

    def step(state, f):
        inside = F.array_max(F.slice(state["ends"], F.lit(1), f["priority"] + 1)) >= -f["until"]
        ends = F.transform(state["ends"], lambda e, level: F.when(level == f["priority"], F.greatest(e, -f["until"])).otherwise(e))
        kept = F.struct(ends.alias("ends"), F.array_union(state["labels"], F.array(f["label"])).alias("labels"), F.greatest(state["score"], f["weight"]).alias("score"), (state["n"] + 1).alias("n"))
        return F.when(inside, state).otherwise(kept)

    return F.aggregate(finds, start, step)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, n_found and score of every row.

    base_labels and labels are sorted arrays; labels holds the base ones and the rules'. score is the best weight
    of a kept find, at least 0.5 with a base phrase, 0 without any. All in one projection: no shuffle, and a text
    is one row throughout, however many finds it has. A null or empty text has no words; repeated rows each come
    back; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), item_words(F.col(text_col)).alias("norm"))
    padded = F.concat(F.lit(" "), F.col("norm"), F.lit(" "))
    rows = rows.select("doc_id", F.when(F.col("norm") == "", 0).otherwise(spaces(F.col("norm")) + 1).alias("n_words"), padded.alias("padded"))

    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in BASE:
        there = F.contains("padded", F.lit(f" {phrase} "))
        tail = F.substring_index("padded", f" {phrase} ", -1)
        counts.append(F.when(there, F.regexp_count("padded", F.lit(f" {phrase}(?= )"))).otherwise(0))
        firsts.append(F.when(there, spaces(F.substr("padded", F.lit(1), F.instr("padded", f" {phrase} "))) - 1))
        lasts.append(F.when(there, F.col("n_words") - spaces(tail) - len(phrase.split())))
        labels.append(F.when(there, F.lit(label)))
    base = F.array_sort(F.array_compact(F.array(*labels)))
    gate = F.col("padded").rlike(f" (?:{'|'.join(sorted(rules()))}) ")
    kept = F.when(gate, let(_rule_map(), lambda rule_map: let(F.split(F.trim("padded"), " "), lambda words: _kept(_finds(words, rule_map)))))
    rows = rows.select("doc_id", "n_words", sum(counts).alias("n_base"), F.least(*firsts).alias("first_word"), F.greatest(*lasts).alias("last_word"), base.alias("base_labels"), kept.alias("kept"))
    own = F.coalesce("kept.labels", F.array().cast("array<string>"))
    score = F.greatest(F.coalesce("kept.score", F.lit(0.0)), F.when(F.col("n_base") > 0, 0.5).otherwise(0.0))
    return rows.select(
        "doc_id",
        *[F.col(c).cast("long").alias(c) for c in ("n_words", "n_base", "first_word", "last_word")],
        "base_labels",
        F.array_sort(F.array_union("base_labels", own)).alias("labels"),
        F.coalesce("kept.n", F.lit(0)).cast("long").alias("n_found"),
        score.alias("score"),
    )
