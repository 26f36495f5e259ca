"""Signature rules of licences: label, priority, keyword, patterns.

One block per licence: `[label priority keyword]` and below it its patterns, one a line, hand-written over a text in
lower case whose words (letters, digits, everything outside ASCII) are separated by single spaces. A pattern is
tried only where the text holds the keyword, so the keyword must lie in everything that the pattern can match: a
licence has a block for each keyword. Priority 3 marks full titles and grants, 2 short names, 1 hints.
"""

RULES = r"""
[mit 3 mit]
(?:released|licensed|available|distributed|published) under (?:the )?(?:terms of the )?mit licen[cs]e
the mit licen[cs]e mit
mit licen[cs]e copyright
[mit 2 mit]
the mit licen[cs]e
mit licen[cs]ed
mit licen[cs]e
spdx license identifier mit
[mit-0 2 mit]
mit no attribution
spdx license identifier mit 0
[mit-grant 3 free of charge]
permission is hereby granted free of charge to any person obtaining a copy
[mit-grant 3 deal in the software]
to deal in the software without restriction
[mit-grant 3 this permission notice]
the above copyright notice and this permission notice shall be included
[apache-2.0 3 apache]
licensed under the apache licen[cs]e version 2 0
apache licen[cs]e version 2 0 january 2004
(?:released|available|distributed) under (?:the )?(?:terms of the )?apache licen[cs]e (?:version )?2 0
[apache-2.0 2 apache]
apache licen[cs]e (?:version |v)?2(?: 0)?
apache 2(?: 0)? licen[cs]ed?
apache org licenses license 2 0
spdx license identifier apache 2 0
asl 2 0 apache
[apache-1.1 2 apache]
apache software licen[cs]e (?:version )?1 1
spdx license identifier apache 1 1
[apache-1.0 2 apache]
apache licen[cs]e (?:version )?1 0
spdx license identifier apache 1 0
[apache 1 apache]
apache (?:software )?licen[cs]e
apache software foundation
[gpl-3.0-or-later 3 general public]
gnu general public licen[cs]e (?:as published by the free software foundation )?(?:either )?version 3 (?:of the licen[cs]e )?or (?:at your option )?any later version
[gpl-3.0-or-later 2 gpl]
gpl 3 0 or later
spdx license identifier gpl 3 0 or later
[gpl-3.0 3 general public]
gnu general public licen[cs]e version 3
general public licen[cs]e v(?:ersion )?3(?: 0)?
gnu general public licen[cs]e gpl v?3
[gpl-3.0 2 gpl]
gnu gpl (?:version |v)?3(?: 0)?
gpl ?(?:version |v)?3(?: 0)?(?: only)?
gplv3
spdx license identifier gpl 3 0(?: only)?
[gpl-2.0-or-later 3 general public]
gnu general public licen[cs]e (?:as published by the free software foundation )?(?:either )?version 2 (?:of the licen[cs]e )?or (?:at your option )?any later version
[gpl-2.0-or-later 2 gpl]
gpl 2 0 or later
gpl ?v?2 or later
[gpl-2.0 3 general public]
gnu general public licen[cs]e version 2
general public licen[cs]e v(?:ersion )?2(?: 0)?
[gpl-2.0 2 gpl]
gnu gpl (?:version |v)?2(?: 0)?
gpl ?(?:version |v)?2(?: 0)?(?: only)?
gplv2
spdx license identifier gpl 2 0(?: only)?
[gpl-1.0 2 gpl]
gpl (?:version |v)?1(?: 0)?
[gpl-any 1 general public]
gnu general public licen[cs]e
under the terms of the general public licen[cs]e
[gpl-any 1 gpl]
gnu gpl
gpl licen[cs]ed?
under the gpl
[gpl-classpath 3 classpath]
classpath exception
gpl 2 0 with classpath exception 2 0
[lgpl-3.0 3 lesser]
gnu lesser general public licen[cs]e (?:version |v)3(?: 0)?
[lgpl-2.1 3 lesser]
gnu lesser general public licen[cs]e (?:version |v)2 1
[lgpl-2.0 3 library general]
gnu library general public licen[cs]e (?:version |v)2(?: 0)?
[lgpl 1 lesser]
gnu lesser general public licen[cs]e
lesser general public licen[cs]e
[lgpl 2 lgpl]
gnu lgpl
lgpl ?(?:version |v)?(?:2 0|2 1|3 0|2|3)?(?: or later)?
spdx license identifier lgpl (?:2 0|2 1|3 0)
[agpl-3.0 3 affero]
gnu affero general public licen[cs]e (?:version |v)3(?: 0)?
[agpl 1 affero]
gnu affero general public licen[cs]e
affero general public licen[cs]e
[agpl-3.0 2 agpl]
gnu agpl (?:version |v)?3(?: 0)?
agpl ?(?:version |v)?3(?: 0)?
spdx license identifier agpl 3 0
[gfdl 3 free documentation]
gnu free documentation licen[cs]e (?:version |v)1 [123]
gnu free documentation licen[cs]e
[gfdl 2 gfdl]
gfdl 1 [123]
gfdl licen[cs]ed
[fsf-all-permissive 3 everyone is permitted]
everyone is permitted to copy and distribute verbatim copies
[cc0-1.0 3 cc0]
cc0 1 0 universal
released under cc0
[cc0-1.0 2 cc0]
cc0(?: 1 0)?
spdx license identifier cc0 1 0
[cc-by-4.0 3 cc by]
licensed under (?:a |the )?cc by 4 0
cc by 4 0(?: international)?
[cc-by-3.0 3 cc by]
cc by 3 0(?: unported)?
[cc-by-2.5 3 cc by]
cc by 2 5
[cc-by-2.0 3 cc by]
cc by 2 0
[cc-by-sa-4.0 3 cc by sa]
cc by sa 4 0(?: international)?
[cc-by-sa-3.0 3 cc by sa]
cc by sa 3 0(?: unported)?
[cc-by-sa 2 cc by sa]
cc by sa(?: 2 [05]| 1 0)?
[cc-by-nc-4.0 3 cc by nc]
(?:licensed|released|available) under (?:a |the )?cc by nc 4 0
cc by nc 4 0(?: international)?
[cc-by-nc-3.0 3 cc by nc]
cc by nc 3 0(?: unported)?
[cc-by-nc 2 cc by nc]
cc by nc(?: 2 [05]| 1 0)?
[cc-by-nd 2 cc by nd]
cc by nd(?: [1234] [05])?
[cc-by-nc-sa 2 cc by nc sa]
cc by nc sa(?: [1234] [05])?
[cc-by-nc-nd 2 cc by nc nd]
cc by nc nd(?: [1234] [05])?
[cc-by-long 3 creative commons attribution]
creative commons attribution (?:licen[cs]e )?[1234] [05]
creative commons attribution licen[cs]e
[cc-by-sa-long 3 creative commons attribution share]
creative commons attribution share ?alike(?: [1234] [05])?
[cc-by-sa-long 3 share alike]
creative commons attribution share alike(?: [1234] [05])?
[cc-by-nc-long 3 creative commons attribution non]
creative commons attribution non ?commercial(?: [1234] [05])?
[cc-by-nc-long 3 non commercial]
creative commons attribution non commercial(?: [1234] [05])?
[cc-by-nc-sa-long 3 creative commons attribution non]
creative commons attribution non ?commercial share ?alike(?: [1234] [05])?
[cc-by-nd-long 3 creative commons attribution no]
creative commons attribution no ?deriv(?:ative)?s(?: [1234] [05])?
[cc-by-nc-nd-long 3 creative commons attribution non]
creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1234] [05])?
[creative-commons 1 creative commons]
creative commons licen[cs]e
creative commons
[creative-commons 1 creativecommons org]
creativecommons org licenses (?:by|by sa|by nc|by nd|by nc sa|by nc nd)
[public-domain 3 public domain]
(?:released|dedicated|placed) (?:in|in to|into|to) the public domain
this (?:work|file|software) is in the public domain
public domain dedication
[public-domain 1 public domain]
public domain
[pddl 3 public domain dedication]
open data commons public domain dedication and licen[cs]e
[pddl 3 pddl]
pddl 1 0
[odbl 3 open database]
open database licen[cs]e
[odbl 3 odbl]
odbl 1 0
[odc-by 3 open data commons]
open data commons attribution licen[cs]e
[odc-by 3 odc by]
odc by(?: 1 0)?
[bsd-3-clause 3 bsd]
bsd 3 clause (?:new |revised )?licen[cs]e
(?:new|revised|modified) bsd licen[cs]e
three clause bsd licen[cs]e
3 clause bsd licen[cs]e
[bsd-3-clause 2 bsd]
bsd 3 clause
spdx license identifier bsd 3 clause
[bsd-2-clause 3 bsd]
bsd 2 clause (?:simplified )?licen[cs]e
(?:simplified|freebsd) bsd licen[cs]e
two clause bsd licen[cs]e
2 clause bsd licen[cs]e
[bsd-2-clause 2 bsd]
bsd 2 clause
spdx license identifier bsd 2 clause
[bsd-4-clause 3 bsd]
bsd 4 clause (?:original |old )?licen[cs]e
original bsd licen[cs]e
four clause bsd licen[cs]e
spdx license identifier bsd 4 clause
[bsd-0-clause 2 0bsd]
0bsd
[bsd-0-clause 2 zero clause]
zero clause bsd
[bsd 1 bsd]
bsd (?:style )?licen[cs]ed?
under the bsd licen[cs]e
[bsd-grant 3 redistribution and use]
redistribution and use in source and binary forms with or without modification are permitted
[bsd-grant 3 redistributions of source]
redistributions of source code must retain the above copyright notice
[bsd-grant 3 redistributions in binary]
redistributions in binary form must reproduce the above copyright notice
[bsd-grant 3 neither the name]
neither the name of .{1,80}? nor the names of its contributors
[isc 3 isc]
isc licen[cs]e
[isc 3 internet systems]
internet systems consortium licen[cs]e
[isc 3 isc]
spdx license identifier isc
[isc-grant 3 permission to use copy modify]
permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
[mpl-2.0 3 mozilla public]
mozilla public licen[cs]e (?:version |v)?2 0
this source code form is subject to the terms of the mozilla public licen[cs]e
[mpl-1.1 3 mozilla public]
mozilla public licen[cs]e (?:version |v)?1 1
[mpl-1.0 3 mozilla public]
mozilla public licen[cs]e (?:version |v)?1 0
[mpl 1 mozilla public]
mozilla public licen[cs]e
[mpl 2 mpl]
mpl (?:version |v)?(?:1 0|1 1|2 0|2)
spdx license identifier mpl (?:1 1|2 0)
[epl-2.0 3 eclipse public]
eclipse public licen[cs]e (?:version |v)?2 0
[epl-1.0 3 eclipse public]
eclipse public licen[cs]e (?:version |v)?1 0
[epl 1 eclipse public]
eclipse public licen[cs]e
[epl 2 epl]
epl (?:version |v)?(?:1 0|2 0)
spdx license identifier epl (?:1 0|2 0)
[edl-1.0 3 eclipse distribution]
eclipse distribution licen[cs]e (?:version |v)?1 0
[eupl 3 european union public]
european union public licen[cs]e(?: (?:version |v)?1 [012])?
[eupl 2 eupl]
eupl(?: (?:version |v)?1 [012])?
[cddl 3 common development and distribution]
common development and distribution licen[cs]e(?: (?:version |v)?1 [01])?
[cddl 2 cddl]
cddl(?: 1 [01])?
[cpl-1.0 3 common public licen]
common public licen[cs]e(?: (?:version |v)?1 0)?
[ipl-1.0 3 ibm public]
ibm public licen[cs]e(?: (?:version |v)?1 0)?
[ms-pl 3 microsoft public]
microsoft public licen[cs]e
[ms-pl 2 ms pl]
ms pl
[ms-rl 3 microsoft reciprocal]
microsoft reciprocal licen[cs]e
[artistic-2.0 3 artistic licen]
artistic licen[cs]e (?:version |v)?2 0
[artistic-1.0 3 artistic licen]
artistic licen[cs]e (?:version |v)?1 0
[artistic 1 artistic licen]
(?:the )?artistic licen[cs]e
[perl 2 as perl]
same terms as perl(?: itself)?
[perl 2 as the perl]
under the same terms as the perl 5 programming language
[zlib 3 zlib]
zlib libpng licen[cs]e
zlib licen[cs]e
spdx license identifier zlib
[zlib-grant 3 as is without any express]
provided as is without any express or implied warranty in no event will the authors be held liable
[libpng 3 libpng]
libpng licen[cs]e
[libpng 3 png reference]
png reference library licen[cs]e
[boost-1.0 3 boost]
boost software licen[cs]e(?: (?:version |v)?1 0)?
distributed under the boost software licen[cs]e
[boost-1.0 2 bsl 1]
bsl 1 0
[busl-1.1 3 business source]
business source licen[cs]e(?: 1 1)?
[sspl-1.0 3 server side public]
server side public licen[cs]e(?: (?:version |v)?1)?
[elastic-2.0 3 elastic licen]
elastic licen[cs]e(?: 2 0)?
[commons-clause 3 commons clause]
commons clause(?: licen[cs]e)? condition
commons clause
[polyform 3 polyform]
polyform (?:noncommercial|small business|shield|strict|perimeter|free trial) licen[cs]e
[unlicense 3 unlicense]
the unlicense
unlicense org
spdx license identifier unlicense
[unlicense-grant 3 free and unencumbered]
this is free and unencumbered software released into the public domain
[wtfpl 3 wtfpl]
wtfpl(?: (?:version |v)?2)?
[wtfpl 3 do what the fuck]
do what the fuck you want to public licen[cs]e
[beerware 3 beer]
beer ?ware licen[cs]e
buy me a beer in return
[psf-2.0 3 python software foundation]
python software foundation licen[cs]e(?: (?:version |v)?2)?
[psf-2.0 2 psf]
psf licen[cs]e(?: agreement)?
[python-2.0 3 python licen]
python licen[cs]e 2 0
[php-3.01 3 php licen]
php licen[cs]e(?: (?:version |v)?3 0[01])?
[ruby 3 ruby]
ruby licen[cs]e
same terms as ruby(?: itself)?
[openssl 3 openssl]
openssl licen[cs]e
openssl toolkit .{0,40}? licen[cs]e
[ssleay 3 ssleay]
(?:original )?ssleay licen[cs]e
[curl 3 curl licen]
curl licen[cs]e
[ncsa 3 illinois]
university of illinois (?:ncsa )?open source licen[cs]e
[ncsa 3 ncsa]
ncsa open source licen[cs]e
[w3c 3 w3c]
w3c software (?:notice and )?licen[cs]e
w3c document licen[cs]e
[ofl-1.1 3 open font]
sil open font licen[cs]e(?: (?:version |v)?1 [01])?
open font licen[cs]e
[ofl-1.1 2 ofl]
ofl 1 [01]
[ipa 3 ipa font]
ipa font licen[cs]e
[bitstream-vera 3 bitstream vera]
bitstream vera (?:fonts? )?(?:copyright|licen[cs]e)
[afl-3.0 3 academic free]
academic free licen[cs]e(?: (?:version |v)?[123] [01])?
[osl-3.0 3 open software licen]
open software licen[cs]e(?: (?:version |v)?[123] [01])?
[ecl-2.0 3 educational community]
educational community licen[cs]e(?: (?:version |v)?[12] 0)?
[cecill 3 cecill]
cecill(?: (?:b|c|version|v)?(?: ?[12] [01])?)?(?: licen[cs]e)?
[qpl-1.0 3 q public]
q public licen[cs]e(?: 1 0)?
[sleepycat 3 sleepycat]
sleepycat licen[cs]e
[postgresql 3 postgresql licen]
postgresql licen[cs]e
[upl-1.0 3 universal permissive]
universal permissive licen[cs]e(?: (?:version |v)?1 0)?
[mulan 3 mulan]
mulan (?:permissive|public) (?:software )?licen[cs]e(?: (?:version |v)?[12])?
[blue-oak 3 blue oak]
blue oak model licen[cs]e(?: 1 0 0)?
[vim 3 vim licen]
vim licen[cs]e
[tcl 3 tcl]
tcl tk licen[cs]e
[x11 3 x11]
x11 licen[cs]e
mit x11
[x-consortium 3 x consortium]
x consortium licen[cs]e
[hpnd 3 historical permission]
historical permission notice and disclaimer
[unicode 3 unicode]
unicode (?:inc )?licen[cs]e agreement
unicode terms of use
[icu 3 icu licen]
icu licen[cs]e
[naist 3 naist]
naist (?:2003 )?licen[cs]e
[json 3 not evil]
software shall be used for good not evil
[json 2 json licen]
json licen[cs]e
[openldap 3 openldap]
openldap public licen[cs]e(?: (?:version |v)?2 8)?
[zpl-2.1 3 zope]
zope public licen[cs]e(?: (?:version |v)?2 [01])?
[lppl-1.3c 3 latex project]
latex project public licen[cs]e(?: (?:version |v)?1 [0123]c?)?
[ftl 3 freetype]
freetype (?:project )?licen[cs]e
[ijg 3 jpeg group]
independent jpeg group(?: s)? (?:software|licen[cs]e)
[nasa-1.3 3 nasa open]
nasa open source agreement(?: 1 3)?
[ogl-uk 3 open government]
open government licen[cs]e(?: (?:version |v)?[123] 0)?
[etalab 3 licence ouverte]
licence ouverte(?: etalab)?
[dl-de 3 datenlizenz]
datenlizenz deutschland (?:namensnennung|zero)
[gpl-fr 3 licence publique]
licence publique g[ée]n[ée]rale
[mit-fr 3 licence mit]
sous licence mit
[mit-de 3 mit lizenz]
mit lizenz
[apache-de 3 apache lizenz]
apache lizenz(?: version 2 0)?
[gpl-es 3 licencia p]
licencia p[úu]blica general
[openrail 3 rail]
(?:bigscience |creativeml )?open ?rail(?: [ms]{1,2})?(?: licen[cs]e)?
[llama 3 community licen]
llama [234] community licen[cs]e(?: agreement)?
[proprietary 3 proprietary]
proprietary and confidential
proprietary licen[cs]e
[proprietary 3 unauthorized copying]
unauthorized copying of this file
[proprietary 2 confidential]
strictly confidential do not distribute
[reserved-long 3 rights reserved]
copyright (?:c )?\d{4}.{0,60}? all rights reserved
all rights reserved(?: no part of this)?
[reserved-long 2 droits]
tous droits r[ée]serv[ée]s
[reserved-long 2 rechte vorbehalten]
alle rechte vorbehalten
[reserved-long 2 derechos reservados]
todos los derechos reservados
[some-rights 2 rights reserved]
some rights reserved
[copyright 1 copyright]
copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)?\d\d)?
[copyright 1 ©]
© ?(?:19|20)\d\d
[no-warranty 1 warranty]
without warranty of any kind
without any warranty
[see-license 1 licen]
see (?:the )?licen[cs]e(?: file)? for (?:details|more information)
see the accompanying licen[cs]e
refer to the licen[cs]e
[spdx 1 spdx]
spdx license identifier [a-z0-9]+(?: [0-9]+){0,3}
[licensed-under 1 licen]
licen[cs]ed under the [a-z0-9]+(?: [a-z0-9]+){0,3} licen[cs]e
"""
