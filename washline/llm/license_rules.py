"""Signatures of licences: ordered rules of regular expressions over a text's words.

A rule has a level, a label, keywords, and a pattern over words that are parted by one blank.  Every
match of the pattern holds all keywords, which are looked for first; `=word` asks for the whole word.
Of overlapping matches a lower level wins, then the longer match, then the earlier rule.

Levels: 0 words of the licence itself, 1 a name with its version, 2 a name, 3 a mention of rights.

Patterns use only what Java's and RE2's syntax share: groups without capture, `?`, `{m,n}`, `|` and `[^ ]`.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    level: int
    label: str
    keywords: tuple[str, ...]
    pattern: str
    base: bool = False


# The phrases that every scan looks for, with their labels.
BASE = [("cc by", "cc-by", "=cc"), ("general public license", "gpl", "general public"), ("all rights reserved", "reserved", "rights reserved")]

#: A blank part: level, label, keywords; then the pattern.
WRITTEN = r"""
0 mit          permission hereby granted    :: permission is hereby granted free of charge to any person obtaining a copy
0 mit          software merchantability     :: the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
0 mit          substantial portions         :: the above copyright notice and this permission notice shall be included in all copies or substantial portions
0 mit-0        permission hereby furnished :: permission is hereby granted free of charge to any person obtaining a copy [^ ]+(?: [^ ]+){0,40} to permit persons to whom the software is furnished to do so the software is provided
0 isc          permission granted purpose   :: permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided
0 0bsd         permission granted purpose   :: permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted the software
0 isc          author disclaims             :: the author disclaims all warranties with regard to this software
0 bsd          redistribution binary        :: redistribution and use in source and binary forms with or without modification are permitted
0 bsd-2-clause redistribution binary        :: redistributions in binary form must reproduce the above copyright notice
0 bsd-3-clause endorse promote              :: may be used to endorse or promote products derived from this software without specific prior written permission
0 bsd-4-clause advertising acknowledg       :: all advertising materials mentioning features or use of this software must display the following acknowledge?ment
0 apache-2.0   unless agreed distributed  :: unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
0 apache-2.0   apache version               :: licensed under the apache license version 2 0 the license
0 apache-2.0   contributor perpetual      :: each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable
0 gpl          redistribute modify terms    :: you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation
0 lgpl         redistribute modify terms  :: you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license
0 agpl         redistribute modify affero   :: you can redistribute it and or modify it under the terms of the gnu affero general public license
0 gpl          hope useful warranty         :: distributed in the hope that it will be useful but without any warranty
0 gpl          received general             :: you should have received a copy of the gnu general public license
0 lgpl         received general           :: you should have received a copy of the gnu (?:lesser|library) general public license
0 agpl         received affero              :: you should have received a copy of the gnu affero general public license
0 gpl-3.0      everyone verbatim            :: everyone is permitted to copy and distribute verbatim copies of this license document
0 mpl-2.0      source subject mozilla       :: this source code form is subject to the terms of the mozilla public license
0 mpl-1.1      contents subject mozilla     :: the contents of this file are subject to the mozilla public license version 1 1
0 epl-2.0      accompanying eclipse         :: this program and the accompanying materials are made available under the terms of the eclipse public license (?:v )?(?:v)?2 0
0 epl-1.0      accompanying eclipse         :: this program and the accompanying materials are made available under the terms of the eclipse public license (?:v )?(?:v)?1 0
0 unlicense    unencumbered                 :: this is free and unencumbered software released into the public domain
0 unlicense    anyone free compile          :: anyone is free to copy modify publish use compile sell or distribute this software
0 wtfpl        fuck                         :: do what the fuck you want to public license
0 zlib         altered misrepresented       :: altered source versions must be plainly marked as such and must not be misrepresented
0 zlib         origin misrepresented        :: the origin of this software must not be misrepresented
0 boost-1.0    permission accompanying    :: permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
0 artistic-2.0 artistic                     :: this package is free software you may use(?: copy modify and distribute)? it under the (?:terms of the )?artistic license
0 perl         perl itself                  :: you can redistribute it and or modify it under the same terms as perl(?: [^ ]+){0,4} itself
0 ofl-1.1      sil open                     :: this font software is licensed under the sil open font license
0 ofl-1.1      font reserved                :: with reserved font name
0 cc0-1.0      waive neighboring          :: has waived all copyright and related or neighboring rights
0 cc0-1.0      dedicated commons            :: dedicated to the public domain(?: [^ ]+){0,6} creative commons
0 cc-by        share redistribute         :: you are free to share copy and redistribute the material in any medium or format
0 cc-by-sa     distribute contributions     :: you must distribute your contributions under the same license as the original
0 cc-by-nc     commercial material          :: you may not use the material for commercial purposes
0 cc-by-nd     remix distribute modified    :: if you remix transform or build upon the material you may not distribute the modified material
0 openssl      openssl project            :: this product includes software developed by the openssl project
0 ssleay       eric young                   :: this product includes cryptographic software written by eric young
0 jpeg         independent jpeg             :: this software is based in part on the work of the independent jpeg group
0 freetype     freetype portions            :: portions of this software are copyright [^ ]+(?: [^ ]+){0,3} the freetype project
0 libpng       png reference                :: the png reference library is supplied as is
0 unicode      unicode data                 :: permission is hereby granted free of charge to any person obtaining a copy of the unicode data files
0 w3c          obtaining licensee         :: by obtaining(?: using and or copying)? this work you the licensee agree
0 x11          x consortium                 :: the name of the x consortium shall not be used in advertising
0 hpnd         permission purpose documentation :: permission to use copy modify and distribute this software and its documentation for any purpose
0 curl         permission purpose provided :: permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
0 beerware     beer                         :: you can buy me a beer in return
0 json         software good evil           :: the software shall be used for good not evil
0 proprietary  confidential proprietary     :: (?:proprietary and confidential|confidential and proprietary)
0 proprietary  unauthorized prohibited    :: unauthorized (?:copying|reproduction|use|distribution)(?: [^ ]+){0,8} is strictly prohibited
0 proprietary  reproduced permission        :: (?:no part of this|may not be)(?: [^ ]+){0,6} reproduced(?: [^ ]+){0,16} without(?: the)?(?: express)?(?: prior)?(?: written)? permission
1 gfdl-1.3     gnu documentation            :: gnu free documentation license version 1 3
1 gfdl-1.2     gnu documentation            :: gnu free documentation license version 1 2
1 gfdl-1.1     gnu documentation            :: gnu free documentation license version 1 1
1 bsd-0-clause bsd                          :: (?:0|zero) clause bsd(?: licen[cs]e)?
1 bsd-1-clause bsd                          :: (?:1|one) clause bsd(?: licen[cs]e)?
1 bsd-2-clause bsd                          :: (?:2|two) clause bsd(?: licen[cs]e)?
1 bsd-3-clause bsd                          :: (?:3|three) clause bsd(?: licen[cs]e)?
1 bsd-4-clause bsd                          :: (?:4|four) clause bsd(?: licen[cs]e)?
1 bsd-2-clause bsd clause                   :: bsd (?:2|two) clause(?: licen[cs]e)?
1 bsd-3-clause bsd clause                   :: bsd (?:3|three) clause(?: licen[cs]e)?
1 bsd-4-clause bsd clause                   :: bsd (?:4|four) clause(?: licen[cs]e)?
1 bsd-2-clause simplified bsd               :: simplified bsd(?: licen[cs]e)?
1 bsd-2-clause freebsd licen                :: freebsd licen[cs]e
1 bsd-3-clause bsd                        :: (?:new|modified|revised) bsd(?: licen[cs]e)?
1 bsd-4-clause bsd                        :: (?:original|old) bsd(?: licen[cs]e)?
1 gpl-2.0-classpath classpath exception     :: (?:gnu )?classpath exception
1 gpl-3.0-gcc  runtime exception gcc        :: gcc runtime library exception
1 boost-1.0    boost software               :: boost software license(?: version)?(?: 1 0)?
1 ofl-1.1      sil open                     :: sil open font license(?: version)?(?: 1 1)?
1 odbl-1.0     open database                :: open database license(?: odbl)?(?: v1 0)?
1 odc-by-1.0   open commons attribution     :: open data commons attribution license(?: v1 0)?
1 pddl-1.0     open commons dedication      :: open data commons public domain dedication(?: and license)?
1 cdla-permissive-1.0 community data permissive :: community data license agreement permissive(?: version)?(?: 1 0)?
1 cdla-sharing-1.0 community data sharing   :: community data license agreement sharing(?: version)?(?: 1 0)?
1 ms-pl        microsoft public             :: microsoft public licen[cs]e(?: ms pl)?
1 ms-rl        microsoft reciprocal         :: microsoft reciprocal licen[cs]e(?: ms rl)?
1 bigscience-openrail-m openrail            :: (?:bigscience )?openrail m(?: licen[cs]e)?
1 creativeml-openrail-m creativeml          :: creativeml open(?: )?rail(?: )?m(?: licen[cs]e)?
1 ogl-uk-3.0   open government              :: open government licen[cs]e(?: for public sector information)? v(?: )?3(?: 0)?
1 ogl-uk-2.0   open government              :: open government licen[cs]e(?: for public sector information)? v(?: )?2(?: 0)?
1 bsl-1.1      business source              :: business source license(?: version)?(?: 1 1)?
1 sspl-1.0     server side                  :: server side public license(?: version)?(?: v)?(?: 1)?
1 elastic-2.0  elastic licen                :: elastic license(?: version)?(?: v)?(?: )?2(?: 0)?
1 polyform     polyform                     :: polyform (?:noncommercial|perimeter|shield|strict|small business|free trial)(?: license)?(?: 1 0 0)?
2 mit          =mit licen                   :: (?:the )?mit licen[cs]e
2 mit          =mit licen                   :: mit licensed
2 mit          expat licen                  :: expat licen[cs]e
2 x11          =x11 licen                   :: x11 licen[cs]e
2 isc          =isc licen                   :: isc licen[cs]e
2 bsd          bsd licen                    :: bsd(?: style)? licen[cs]e
2 bsd          bsd licen                    :: bsd licensed
2 apache       apache licen                 :: (?:the )?apache(?: software)? licen[cs]e
2 apache       apache licen                 :: apache licensed
2 mpl          mozilla public               :: mozilla public licen[cs]e
2 epl          eclipse public               :: eclipse public licen[cs]e
2 cpl          common public licen          :: common public licen[cs]e
2 cddl         common distribution          :: common development and distribution licen[cs]e
2 eupl         european union public        :: european union public licen[cs]e
2 gpl          =gpl                         :: (?:gnu )?gpl(?: licen[cs]ed?)?
2 gpl          gnu general                  :: gnu general public licen[cs]e
2 lgpl         lgpl                         :: (?:gnu )?lgpl(?: licen[cs]ed?)?
2 lgpl         general public             :: (?:gnu )?(?:lesser|library) general public licen[cs]e
2 agpl         agpl                         :: (?:gnu )?agpl(?: licen[cs]ed?)?
2 agpl         affero general               :: (?:gnu )?affero general public licen[cs]e
2 gfdl         documentation licen          :: (?:gnu )?free documentation licen[cs]e
2 gfdl         gfdl                         :: (?:gnu )?gfdl
2 zlib         zlib licen                   :: zlib(?: libpng)? licen[cs]e
2 libpng       libpng licen                 :: libpng licen[cs]e
2 curl         curl licen                   :: curl licen[cs]e
2 openssl      openssl licen                :: openssl licen[cs]e
2 php          =php licen                   :: php licen[cs]e(?: version)?(?: 3 01?)?
2 python       python licen                 :: python(?: software foundation)? licen[cs]e(?: version)?(?: 2)?
2 psf          =psf licen                   :: psf licen[cs]e
2 ruby         ruby licen                   :: ruby licen[cs]e
2 perl         perl licen                   :: perl(?: 5)? licen[cs]e
2 artistic     artistic licen               :: (?:perl )?artistic licen[cs]e
2 vim          =vim licen                   :: vim licen[cs]e
2 zope         zope public                  :: zope public licen[cs]e
2 w3c          w3c licen                    :: w3c(?: software)?(?: and document)?(?: notice and)? licen[cs]e
2 ncsa         ncsa                         :: (?:university of illinois )?ncsa(?: open source)? licen[cs]e
2 postgresql   postgresql licen             :: postgresql licen[cs]e
2 unicode      unicode licen                :: unicode(?: [^ ]+){0,4} licen[cs]e(?: agreement)?
2 icu          =icu licen                   :: icu licen[cs]e
2 intel        intel licen                  :: intel(?: simplified)?(?: open source)? licen[cs]e
2 ibm          =ibm public                  :: ibm public licen[cs]e
2 qpl          =q public                    :: q public licen[cs]e
2 sleepycat    sleepycat                    :: sleepycat licen[cs]e
2 netscape     netscape public              :: netscape public licen[cs]e
2 apple-psl    apple public                 :: apple public source licen[cs]e
2 nasa         nasa open                    :: nasa open source agreement
2 reciprocal   reciprocal public            :: reciprocal public licen[cs]e
2 watcom       watcom                       :: sybase open watcom public licen[cs]e
2 lucent       lucent public                :: lucent public licen[cs]e
2 nokia        nokia open                   :: nokia open source licen[cs]e
2 realnetworks realnetworks                 :: realnetworks public source licen[cs]e
2 ricoh        ricoh source                 :: ricoh source code public licen[cs]e
2 sun-public   =sun public                  :: sun public licen[cs]e
2 vovida       vovida                       :: vovida software licen[cs]e
2 latex        latex project                :: latex project public licen[cs]e
2 mulan        mulan                        :: mulan (?:psl|publ|permissive software) (?:v2|licen[cs]e)
2 upl          universal permissive         :: universal permissive licen[cs]e
2 blueoak      blue oak                     :: blue oak model licen[cs]e
2 hippocratic  hippocratic                  :: hippocratic licen[cs]e
2 free-art     =art                       :: (?:free art licen[cs]e|licence art libre)
2 cecill       cecill                       :: cecill(?: [abc])?
2 etalab       licence                    :: (?:licence ouverte(?: etalab)?|etalab(?: [^ ]+){0,2} licence)
2 dl-de        datenlizenz                  :: datenlizenz deutschland(?: [^ ]+){0,3}
2 lizenz       lizenz                       :: (?:lizenziert unter|steht unter)(?: [^ ]+){0,6} lizenz
2 licencia     licencia                     :: (?:licenciado bajo|bajo(?: la| una)? licencia)
2 licence      licence                      :: (?:sous licence|distribu[^ ]+ sous(?: la)? licence)
2 cc-by        creative attribution         :: creative commons attribution(?: licen[cs]e)?
2 cc-by-sa     creative share               :: creative commons attribution share(?: )?alike
2 cc-by-nc     creative commercial          :: creative commons attribution non(?: )?commercial
2 cc-by-nd     creative deriv               :: creative commons attribution no(?: )?derivatives
2 cc-by-nc-sa  creative commercial share    :: creative commons attribution non(?: )?commercial share(?: )?alike
2 cc-by-nc-nd  creative commercial deriv    :: creative commons attribution non(?: )?commercial no(?: )?derivatives
2 cc           creative commons             :: creative commons(?: licen[cs]e)?
2 cc0          =cc0                         :: cc0(?: licen[cs]e)?
2 cc-by-sa     =cc                          :: cc by sa
2 cc-by-nc     =cc                          :: cc by nc
2 cc-by-nd     =cc                          :: cc by nd
2 cc-by-nc-sa  =cc                          :: cc by nc sa
2 cc-by-nc-nd  =cc                          :: cc by nc nd
2 public-domain public domain               :: (?:in|into|to) the public domain
2 public-domain public domain               :: public domain(?: dedication| mark)
2 llama        llama licen                  :: llama(?: 2| 3| 3 [0-9])?(?: community)? licen[cs]e(?: agreement)?
2 gemma        gemma terms                  :: gemma terms of use
2 eula         user licen                   :: end user licen[cs]e agreement
2 freeware     freeware                     :: freeware(?: licen[cs]e)?
2 shareware    shareware                    :: shareware(?: licen[cs]e)?
2 dual         dual licen                   :: dual licensed(?: under)?
3 copyright    copyright                    :: copyright(?: c| copy)? (?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2}){0,12}
3 copyright    copyright                    :: (?:c )?copyright(?: c)? by
3 copyleft     copyleft                     :: copyleft
3 reserved     reserved                     :: (?:some|no) rights reserved
3 licensed     licensed                     :: (?:is |are )?licensed under(?: the| a| an)?
3 licensed     released                     :: (?:is |are )?released under(?: the| a| an)?
3 licensed     distributed                  :: (?:is |are )?distributed under(?: the| a| an)? (?:terms|licen[cs]e|conditions)
3 licensed     licen see                    :: see(?: the)? licen[cs]e(?: file)?(?: for)?
3 licensed     spdx identifier              :: spdx license identifier [^ ]+
3 licensed     licen =of                 :: (?:terms|conditions) of(?: the| this)? licen[cs]e
3 no-warranty  without warrant              :: without(?: any)? warrant(?:y|ies)
3 no-warranty  merchantability              :: merchantability(?: or| and)? fitness for a particular purpose
3 no-warranty  event liable               :: in no event shall(?: [^ ]+){0,12} be liable
3 trademark    trademark                    :: (?:is a|are)(?: registered)? trademarks? of
3 permission   reprinted permission         :: reprinted (?:with|by)(?: [^ ]+){0,3} permission
3 fair-use     fair use                     :: fair use(?: act| notice| doctrine)?
"""

#: Names that come with versions: label, keywords, the name's pattern, versions.
VERSIONED = [
    ("apache", "apache", "(?:the )?apache(?: software)? licen[cs]e", "1.0 1.1 2.0"),
    ("apache", "=apache", "apache", "2.0"),
    ("gpl", "gpl", "(?:gnu )?gpl", "1.0 2.0 3.0"),
    ("gpl", "general public", "(?:gnu )?general public licen[cs]e", "1.0 2.0 3.0"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl", "2.0 2.1 3.0"),
    ("lgpl", "general public", "(?:gnu )?(?:lesser|library) general public licen[cs]e", "2.0 2.1 3.0"),
    ("agpl", "agpl", "(?:gnu )?agpl", "1.0 3.0"),
    ("agpl", "affero general", "(?:gnu )?affero general public licen[cs]e", "1.0 3.0"),
    ("mpl", "mozilla public", "mozilla public licen[cs]e", "1.0 1.1 2.0"),
    ("mpl", "=mpl", "mpl", "1.0 1.1 2.0"),
    ("epl", "eclipse public", "eclipse public licen[cs]e", "1.0 2.0"),
    ("epl", "=epl", "epl", "1.0 2.0"),
    ("cddl", "cddl", "cddl", "1.0 1.1"),
    ("cddl", "common distribution", "common development and distribution licen[cs]e(?: cddl)?", "1.0 1.1"),
    ("eupl", "eupl", "eupl", "1.0 1.1 1.2"),
    ("eupl", "european union public", "european union public licen[cs]e", "1.0 1.1 1.2"),
    ("artistic", "artistic", "artistic licen[cs]e", "1.0 2.0"),
    ("afl", "academic free", "academic free licen[cs]e", "1.1 1.2 2.0 2.1 3.0"),
    ("osl", "open software", "open software licen[cs]e", "1.0 1.1 2.0 2.1 3.0"),
    ("zpl", "zope public", "zope public licen[cs]e", "1.1 2.0 2.1"),
    ("lppl", "latex project", "latex project public licen[cs]e", "1.0 1.1 1.2 1.3"),
    ("cecill", "cecill", "cecill(?: free software licen[cs]e agreement)?", "1.0 1.1 2.0 2.1"),
    ("cc0", "=cc0", "cc0", "1.0"),
    ("cc-by", "=cc", "cc by", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-sa", "=cc", "cc by sa", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc", "=cc", "cc by nc", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nd", "=cc", "cc by nd", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc-sa", "=cc", "cc by nc sa", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc-nd", "=cc", "cc by nc nd", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by", "creative attribution", "creative commons attribution(?: licen[cs]e)?", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-sa", "creative share", "creative commons attribution share(?: )?alike(?: licen[cs]e)?", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc", "creative commercial", "creative commons attribution non(?: )?commercial(?: licen[cs]e)?", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nd", "creative deriv", "creative commons attribution no(?: )?derivatives(?: licen[cs]e)?", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc-sa", "creative commercial share", "creative commons attribution non(?: )?commercial share(?: )?alike(?: licen[cs]e)?", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc-nd", "creative commercial deriv", "creative commons attribution non(?: )?commercial no(?: )?derivatives(?: licen[cs]e)?", "1.0 2.0 2.5 3.0 4.0"),
]

#: Licences that may be taken in a later version, too.
OR_LATER = {"gpl", "lgpl", "agpl"}


def _written() -> list[Rule]:
    rules = []
    for line in WRITTEN.strip().splitlines():
        head, pattern = line.split(" :: ")
        level, label, *keywords = head.split()
        rules.append(Rule(int(level), label, tuple(keywords), pattern))
    return rules


def _versioned() -> list[Rule]:
    rules = []
    for label, keywords, name, versions in VERSIONED:
        for version in versions.split():
            major, minor = version.split(".")
            number = f"{major} {minor}" if minor != "0" else f"{major}(?: 0)?"
            pattern = f"(?:{name}) (?:version |ver |v )?v?{number}(?: international| unported| only)?"
            found = tuple(keywords.split())
            if label in OR_LATER:
                later = r"(?: of the licen[cs]e)?(?: or(?: at your option)?(?: any)? later(?: version)?)"
                rules.append(Rule(1, f"{label}-{version}-or-later", (*found, "later"), pattern + later))
            rules.append(Rule(1, f"{label}-{version}", found, pattern))
            if name in {"(?:gnu )?gpl", "(?:gnu )?lgpl", "(?:gnu )?agpl"}:
                rules.append(Rule(1, f"{label}-{version}", found, f"{label}v?{number}"))
    return rules


RULES = _written() + _versioned() + [Rule(3, label, tuple(keywords.split()), phrase, True) for phrase, label, keywords in BASE]
