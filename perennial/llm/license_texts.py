"""Licence texts, headers, titles and tags that windows of a file are compared with.

Short licences stand whole, without year and owner. Of the long ones stand the
title and opening, and the notices their texts recommend for headers.
"""

from __future__ import annotations

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
    "is furnished to do so"
)
_MIT_KEEP = (
    ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
    "or substantial portions of the Software."
)
_MIT_DISCLAIMER = (
    " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
    "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
    "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_GRANT = (
    "All rights reserved. Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list "
    "of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_ADVERT = (
    " 3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This "
    "product includes software developed by the organization."
)
_BSD_NAMES = (
    " {n}. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
_BSD_DISCLAIMER = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
    "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_KEEP = ", provided that the above copyright notice and this permission notice appear in all copies."
_ISC_DISCLAIMER = (
    " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
    "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
    "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this "
    "software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a "
    "product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must "
    "be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or "
    "altered from any source distribution."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
    "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
    "non-commercial, and by any means."
)
_BOOST = (
    "Boost Software License - Version 1.0 - August 17th, 2003. Permission is hereby granted, free of charge, to any person or "
    "organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, "
    "reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software"
)
_APACHE_NOTICE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
    "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
    "agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
    "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
    "limitations under the License."
)
_APACHE_TITLE = "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"
_APACHE_OPENING = " TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions."
_MPL_NOTICE = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
    "with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
)
_MPL_OPENING = (
    "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity that creates, "
    "contributes to the creation of, or owns Covered Software."
)
_MPL_1_NOTICE = (
    "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file "
    "except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/ Software distributed "
    "under the License is distributed on an \"AS IS\" basis, WITHOUT WARRANTY OF ANY KIND, either express or implied. See the License "
    "for the specific language governing rights and limitations under the License."
)
_GNU_COPY = (
    " Free Software Foundation, Inc.{site} Everyone is permitted to copy and distribute verbatim copies of this license document, but "
    "changing it is not allowed."
)
_GNU_TITLES = [
    ("GPL-1.0", "GNU GENERAL PUBLIC LICENSE Version 1, February 1989", " Copyright (C) 1989"),
    ("GFDL-1.2", "GNU Free Documentation License Version 1.2, November 2002", " Copyright (C) 2000, 2001, 2002"),
    ("GFDL-1.3", "GNU Free Documentation License Version 1.3, 3 November 2008", " Copyright (C) 2000, 2001, 2002, 2007, 2008"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", " Copyright (C) 1989, 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", " Copyright (C) 2007"),
    ("LGPL-2.0", "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991", " Copyright (C) 1991"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", " Copyright (C) 1991, 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", " Copyright (C) 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", " Copyright (C) 2007"),
]
_GNU_HEADERS = [
    ("GPL-1.0", "GNU General Public License", "1"),
    ("GPL-2.0", "GNU General Public License", "2"),
    ("GPL-3.0", "GNU General Public License", "3"),
    ("LGPL-2.0", "GNU Library General Public License", "2"),
    ("LGPL-2.1", "GNU Lesser General Public License", "2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License", "3"),
    ("AGPL-3.0", "GNU Affero General Public License", "3"),
]
_GNU_LATER = (
    "you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation; either "
    "version {version} of the License, or (at your option) any later version."
)
_GNU_ONLY = (
    "you can redistribute it and/or modify it under the terms of the {name} version {version} as published by the Free Software "
    "Foundation."
)

TEXTS: list[tuple[str, str]] = [
    ("MIT", "MIT License"),
    ("MIT", _MIT_GRANT + _MIT_KEEP + _MIT_DISCLAIMER),
    ("MIT-0", "MIT No Attribution"),
    ("MIT-0", _MIT_GRANT + "." + _MIT_DISCLAIMER),
    ("BSD-2-Clause", _BSD_GRANT + _BSD_DISCLAIMER),
    ("BSD-3-Clause", _BSD_GRANT + _BSD_NAMES.format(n=3) + _BSD_DISCLAIMER),
    ("BSD-4-Clause", _BSD_GRANT + _BSD_ADVERT + _BSD_NAMES.format(n=4) + _BSD_DISCLAIMER),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("ISC", "ISC License"),
    ("ISC", _ISC_GRANT + _ISC_KEEP + _ISC_DISCLAIMER),
    ("0BSD", _ISC_GRANT + "." + _ISC_DISCLAIMER),
    ("Zlib", _ZLIB),
    ("Unlicense", _UNLICENSE),
    ("BSL-1.0", _BOOST),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("WTFPL", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE"),
    ("Apache-2.0", _APACHE_NOTICE),
    ("Apache-2.0", _APACHE_TITLE),
    ("Apache-2.0", _APACHE_TITLE + _APACHE_OPENING),
    ("MPL-2.0", _MPL_NOTICE),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", _MPL_OPENING),
    ("MPL-1.1", _MPL_1_NOTICE),
    ("MPL-1.1", "Mozilla Public License Version 1.1"),
    ("EPL-1.0", "Eclipse Public License - v 1.0"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("GPL", "GNU GENERAL PUBLIC LICENSE"),
    ("LGPL", "GNU LESSER GENERAL PUBLIC LICENSE"),
    ("AGPL", "GNU AFFERO GENERAL PUBLIC LICENSE"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
]
TEXTS += [(name, title) for name, title, _ in _GNU_TITLES]
TEXTS += [(name, title + years + _GNU_COPY.format(site=site)) for name, title, years in _GNU_TITLES for site in ("", " <https://fsf.org/>")]
TEXTS += [(name, form.format(name=full, version=version)) for name, full, version in _GNU_HEADERS for form in (_GNU_LATER, _GNU_ONLY)]

_CC = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
for _kind, _name in _CC.items():
    for _version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        TEXTS += [
            (f"CC-{_kind}-{_version}", f"Licensed under CC {_kind} {_version}."),
            (f"CC-{_kind}-{_version}", f"Creative Commons {_name} {_version}"),
            (f"CC-{_kind}-{_version}", f"SPDX-License-Identifier: CC-{_kind}-{_version}"),
        ]

TEXTS += [
    (name, f"SPDX-License-Identifier: {name}")
    for name in "MIT MIT-0 BSD-2-Clause BSD-3-Clause BSD-4-Clause ISC 0BSD Zlib Unlicense BSL-1.0 WTFPL Apache-1.0 Apache-1.1 Apache-2.0 "
    "MPL-1.0 MPL-1.1 MPL-2.0 EPL-1.0 EPL-2.0 CC0-1.0 Artistic-1.0 Artistic-2.0 OFL-1.0 OFL-1.1 CDDL-1.0 CDDL-1.1 EUPL-1.1 EUPL-1.2 "
    "AFL-3.0 PostgreSQL".split()
]
TEXTS += [
    (name, f"SPDX-License-Identifier: {name}{end}")
    for name in "GPL-1.0 GPL-2.0 GPL-3.0 LGPL-2.0 LGPL-2.1 LGPL-3.0 AGPL-1.0 AGPL-3.0 GFDL-1.1 GFDL-1.2 GFDL-1.3".split()
    for end in ("", "-only", "-or-later")
]
