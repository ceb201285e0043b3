"""Templates of common licences: notices, file headers, SPDX lines and texts, by name."""

from __future__ import annotations

from pathlib import Path

_SPDX = (
    "0BSD AFL-3.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSD-4-Clause "
    "BSL-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 "
    "ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.2 GFDL-1.3-or-later GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later ISC "
    "LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL NCSA OFL-1.1 "
    "PostgreSQL Python-2.0 Unlicense WTFPL Zlib"
).split()

_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT "
    "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission. "
)
_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
    "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
    "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
    "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
    "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)


def _gnu(name: str, version: str) -> str:
    """The words of a file header that tell licence and version; with more of it, headers of others would hold 80 %."""
    return f"under the terms of the {name} as published by the Free Software Foundation, either version {version} of the License"


_HEADERS = {
    "agpl-3.0-header": _gnu("GNU Affero General Public License", "3"),
    "gpl-2.0-header": _gnu("GNU General Public License", "2"),
    "gpl-3.0-header": _gnu("GNU General Public License", "3"),
    "lgpl-2.1-header": _gnu("GNU Lesser General Public License", "2.1"),
    "lgpl-3.0-header": _gnu("GNU Lesser General Public License", "3"),
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
    "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
    "agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
    "ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "epl-2.0-header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "cc-by-4.0-header": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-header": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4.0-header": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "bsd-style-header": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
}
_TEXTS = {
    "bsd-2-or-3-clause-text": _BSD_2 + _WARRANTY,
    "bsd-third-clause": _BSD_3,
    "isc-or-0bsd-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _ISC,
    "isc-notice": "with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
    "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to "
    "do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software. " + _AS_IS,
    "unlicense-text": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
    "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
    "non-commercial, and by any means.",
    "zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
    "any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
    "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "cc0-1.0-header": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this "
    "software to the public domain worldwide. This software is distributed without any warranty.",
}


def common_templates() -> dict[str, str]:
    """Name and text; long texts are files beside this module, as their publishers spread them."""
    files = sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
    long = {f"{f.stem}-text": f.read_text("utf-8") for f in files}
    return {f"{s.lower()}-spdx": f"SPDX-License-Identifier: {s}" for s in _SPDX} | _HEADERS | _TEXTS | long
