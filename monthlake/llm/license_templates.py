"""Whole licenses and license notices as templates (markup: see license_scan).

Fixed values: the wording of public licenses, lower-cased, words alone. Optional regions are wordings that the licenses
themselves leave open; replaceable ones are names, years and the holder's terms.
"""

from __future__ import annotations

HOLDER = "{{1..12}}"

_MIT_GRANT = """permission is hereby granted free of charge to any person obtaining a copy of this software and
associated documentation files the software to deal in the software without restriction including without limitation the
rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to
whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission
notice [[including the next paragraph]] shall be included in all copies or substantial portions of the software"""
_MIT_WARRANTY = """the software is provided as is without warranty of any kind express or implied including but not limited to
the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or
copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise
arising from out of or in connection with the software or the use or other dealings in the software"""

_BSD_HEAD = """redistribution and use in source and binary forms with or without modification are permitted provided that the
following conditions are met [[1|a]] redistributions of source code must retain the above copyright notice this list of
conditions and the following disclaimer [[2|b]] redistributions in binary form must reproduce the above copyright notice
this list of conditions and the following disclaimer in the documentation and or other materials provided with the
distribution"""
_BSD_NAMES = f"""[[3|c]] neither the name of [[the]] {HOLDER} nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission"""
_BSD_WARRANTY = f"""this software is provided by {HOLDER} as is and any express or implied warranties including but not limited
to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {HOLDER}
be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to
procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any
theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out
of the use of this software even if advised of the possibility of such damage"""

_GNU_FREE = """is free software you can redistribute it and or modify it under the terms of the gnu"""
_GNU_PUBLISHED = """as published by the free software foundation [[either]] version {{1..2}} [[of the license]]
[[or at your option any later version]]"""
_GNU_WARRANTY = """is distributed in the hope that it will be useful but without any warranty without even the implied warranty of
merchantability or fitness for a particular purpose see the gnu"""

TEXTS = {
    "mit-text": [f"{_MIT_GRANT} {_MIT_WARRANTY}"],
    "isc-text": [
        """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
        provided that the above copyright notice and this permission notice appear in all copies the software is provided as is
        and the author disclaims all warranties with regard to this software including all implied warranties of
        merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential
        damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract
        negligence or other tortious action arising out of or in connection with the use or performance of this software"""
    ],
    "bsd-2-text": [f"{_BSD_HEAD} {_BSD_WARRANTY}"],
    "bsd-3-text": [f"{_BSD_HEAD} {_BSD_NAMES} {_BSD_WARRANTY}"],
    "zlib-text": [
        """this software is provided as is without any express or implied warranty in no event will the authors be held liable for
        any damages arising from the use of this software permission is granted to anyone to use this software for any purpose
        including commercial applications and to alter it and redistribute it freely subject to the following restrictions
        [[1]] the origin of this software must not be misrepresented you must not claim that you wrote the original software if
        you use this software in a product an acknowledgment in the product documentation would be appreciated but is not
        required [[2]] altered source versions must be plainly marked as such and must not be misrepresented as being the
        original software [[3]] this notice may not be removed or altered from any source distribution"""
    ],
    "boost-text": [
        """permission is hereby granted free of charge to any person or organization obtaining a copy of the software and
        accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit
        the software and to prepare derivative works of the software and to permit third parties to whom the software is
        furnished to do so all subject to the following"""
    ],
    "unlicense-text": [
        """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use
        compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or
        non commercial and by any means"""
    ],
    "apache-2.0-header": [
        """licensed under the apache license version 2 0 the license you may not use [[this file]] except in compliance
        with the license you may obtain a copy of the license at [[http|https]] www apache org licenses license 2 0 unless
        required by applicable law or agreed to in writing software distributed under the license is distributed on an as is
        basis without warranties or conditions of any kind either express or implied see the license for the specific language
        governing permissions and limitations under the license"""
    ],
    "gpl-header": [
        f"""{_GNU_FREE} general public license {_GNU_PUBLISHED} {{{{1..6}}}} {_GNU_WARRANTY} general public license for more details"""
    ],
    "lgpl-header": [
        f"""{_GNU_FREE} [[lesser|library]] general public license {_GNU_PUBLISHED} {{{{1..6}}}} {_GNU_WARRANTY} lesser general public
        license for more details"""
    ],
    "agpl-header": [
        f"""{_GNU_FREE} affero general public license {_GNU_PUBLISHED} {{{{1..6}}}} {_GNU_WARRANTY} affero general public license
        for more details"""
    ],
    "mpl-2.0-header": [
        """this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not
        distributed with this file you can obtain one at [[http|https]] mozilla org mpl 2 0"""
    ],
    "cc0-notice": [
        """to the extent possible under law {{1..12}} has waived all copyright and related or neighboring rights to"""
    ],
    "cc-by-notice": [
        """is licensed under [[a|the]] creative commons attribution {{1..2}} [[0]] [[international|unported|generic]]
        license"""
    ],
    "cc-by-sa-notice": [
        """is licensed under [[a|the]] creative commons attribution share [[alike]] {{1..3}} [[international|unported|generic]] license"""
    ],
}
