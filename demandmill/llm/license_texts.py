"""Licence templates. The public wording of each licence or notice."""

from demandmill.llm import license_bodies as bodies

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions: The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY
KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR
ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice appear in all
copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE
LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING
FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above
copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form
must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE
COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND
ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE."""

BSD_3_CLAUSE = """3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission."""

APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""

GPL_3_HEADER = """This program is free software: you can redistribute it and/or modify it under the terms of
the GNU General Public License as published by the Free Software Foundation, either version 3 of the
License, or (at your option) any later version. This program is distributed in the hope that it will be
useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
PARTICULAR PURPOSE. See the GNU General Public License for more details."""

BSD_4_CLAUSE = """3. All advertising materials mentioning features or use of this software must display the
following acknowledgement: This product includes software developed by the copyright holder. 4."""

ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the
authors be held liable for any damages arising from the use of this software. Permission is granted to
anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be
misrepresented; you must not claim that you wrote the original software. If you use this software in a
product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software. 3. This notice may not be removed or altered from any source distribution."""

MPL_2_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""

MPL_1_1_HEADER = """The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License");
you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.mozilla.org/MPL/ Software distributed under the License is distributed on an "AS IS" basis,
WITHOUT WARRANTY OF ANY KIND, either express or implied. See the License for the specific language
governing rights and limitations under the License."""

EPL_HEADER = """This program and the accompanying materials are made available under the terms of the Eclipse
Public License {} which accompanies this distribution, and is available at {}"""

CC0_HEADER = """To the extent possible under law, the author has waived all copyright and related or neighboring
rights to this work."""

#: Family and version of the GNU licences, and the name that stands before "Public License".
GNU = [
    ("GPL-1.0", "General", "1"),
    ("GPL-2.0", "General", "2"),
    ("GPL-3.0", "General", "3"),
    ("LGPL-2.0", "Library General", "2"),
    ("LGPL-2.1", "Lesser General", "2.1"),
    ("LGPL-3.0", "Lesser General", "3"),
    ("AGPL-3.0", "Affero General", "3"),
]
CREATIVE_COMMONS = ["BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"]


def _gnu_header(kind: str, version: str, what: str) -> str:
    text = GPL_3_HEADER.replace("GNU General", f"GNU {kind}").replace("version 3", f"version {version}")
    return text.replace("This program", f"This {what}")


def _gnu_templates() -> dict[str, str]:
    out = {}
    for name, kind, version in GNU:
        out[f"{name}-header"] = _gnu_header(kind, version, "program")
        out[f"{name}-library-header"] = _gnu_header(kind, version, "library")
        out[f"{name}-notice"] = f"This work is licensed under the GNU {kind} Public License, version {version}."
    return out


TEMPLATES: dict[str, str] = {
    "Apache-1.1-notice": "Licensed under the Apache License, Version 1.1.",
    "Apache-2.0": bodies.APACHE_2,
    "Apache-2.0-header": APACHE_HEADER,
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": BSD_2,
    "BSD-2-Clause-notice": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": BSD_2.replace(" THIS SOFTWARE", f" {BSD_3_CLAUSE} THIS SOFTWARE", 1).replace(
        "\nCOPYRIGHT HOLDERS", " COPYRIGHT HOLDERS", 1
    ),
    "BSD-3-Clause-notice": "Released under the BSD 3-Clause License.",
    "BSD-4-Clause": BSD_2.replace(
        " THIS SOFTWARE", f" {BSD_4_CLAUSE}{BSD_3_CLAUSE[2:]} THIS SOFTWARE", 1
    ),
    "BSD-4-Clause-notice": "Released under the BSD 4-Clause License.",
    **{
        f"CC-{kind}-{version}-notice": f"Licensed under CC {kind} {version}."
        for kind in CREATIVE_COMMONS
        for version in ("2.0", "2.5", "3.0", "4.0")
    },
    "CC0-1.0": bodies.CC0_1,
    "CC0-1.0-header": CC0_HEADER,
    "CC0-1.0-notice": "Licensed under CC0 1.0.",
    "EPL-1.0-header": EPL_HEADER.format("v1.0", "http://www.eclipse.org/legal/epl-v10.html"),
    "EPL-1.0-notice": "Licensed under the Eclipse Public License, Version 1.0.",
    "EPL-2.0-header": EPL_HEADER.format("2.0", "https://www.eclipse.org/legal/epl-2.0/"),
    "EPL-2.0-notice": "Licensed under the Eclipse Public License, Version 2.0.",
    **_gnu_templates(),
    "GPL-2.0": bodies.GPL_2,
    "GPL-3.0": bodies.GPL_3,
    "LGPL-2.0": bodies.LGPL_2,
    "LGPL-2.1": bodies.LGPL_2_1,
    "LGPL-3.0": bodies.LGPL_3,
    "AGPL-3.0": bodies.AGPL_3,
    "ISC": ISC,
    "MIT": MIT,
    "MIT-notice": "Released under the MIT License.",
    "ISC-notice": "Released under the ISC License.",
    "MPL-1.1": bodies.MPL_1_1,
    "MPL-1.1-header": MPL_1_1_HEADER,
    "MPL-1.1-notice": "Licensed under the Mozilla Public License, Version 1.1.",
    "MPL-2.0": bodies.MPL_2,
    "MPL-2.0-header": MPL_2_HEADER,
    "MPL-2.0-notice": "Licensed under the Mozilla Public License, Version 2.0.",
    "Unlicense": bodies.UNLICENSE,
    "Unlicense-notice": "This is free and unencumbered software released into the public domain.",
    "Zlib": ZLIB,
    "Zlib-notice": "Released under the zlib License.",
}
