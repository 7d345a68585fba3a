"""What licences' files, headers and notices say.  Fixed values: public licence texts, copyright lines left out."""

_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_NO_WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_TAIL = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_APACHE_NOTICE = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
_APACHE_TERMS = "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document. \"Licensor\" shall mean the copyright owner or entity authorized by the copyright owner that is granting the License."


def _gnu(name: str, version: str) -> str:
    return f"This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details. You should have received a copy of the {name} along with this program. If not, see <https://www.gnu.org/licenses/>."


def _spdx(name: str) -> str:
    return f"SPDX-License-Identifier: {name}"


#: Whole texts, headers and one-line notices by SPDX name.
TEMPLATES = {
    "0BSD": (_spdx("0BSD"), "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    "AGPL-3.0": (_spdx("AGPL-3.0-only"), _spdx("AGPL-3.0-or-later"), _gnu("GNU Affero General Public License", "3"), "Licensed under the GNU Affero General Public License, version 3."),
    "Apache-2.0": (_spdx("Apache-2.0"), "Licensed under the Apache License, Version 2.0.", _APACHE_NOTICE, _APACHE_TERMS, "This project is released under the Apache 2.0 license."),
    "BSD-2-Clause": (_spdx("BSD-2-Clause"), f"{_BSD_HEAD} {_BSD_TAIL}", "Released under the BSD 2-Clause License."),
    "BSD-3-Clause": (_spdx("BSD-3-Clause"), f"{_BSD_HEAD} {_BSD_THIRD} {_BSD_TAIL}", "Released under the BSD 3-Clause License.", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    "BSL-1.0": (_spdx("BSL-1.0"), "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"),
    "CC-BY-4.0": (_spdx("CC-BY-4.0"), "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": (_spdx("CC-BY-NC-4.0"), "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA-4.0": (_spdx("CC-BY-SA-4.0"), "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0-1.0": (_spdx("CC0-1.0"), "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide under CC0 1.0 Universal."),
    "EPL-2.0": (_spdx("EPL-2.0"), "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    "GPL-2.0": (_spdx("GPL-2.0-only"), _spdx("GPL-2.0-or-later"), _gnu("GNU General Public License", "2"), "This work is licensed under the GNU General Public License, version 2."),
    "GPL-3.0": (_spdx("GPL-3.0-only"), _spdx("GPL-3.0-or-later"), _gnu("GNU General Public License", "3"), "This work is licensed under the GNU General Public License, version 3.", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."),
    "ISC": (_spdx("ISC"), "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.", "Released under the ISC License."),
    "LGPL-2.1": (_spdx("LGPL-2.1-only"), _spdx("LGPL-2.1-or-later"), _gnu("GNU Lesser General Public License", "2.1")),
    "LGPL-3.0": (_spdx("LGPL-3.0-only"), _spdx("LGPL-3.0-or-later"), _gnu("GNU Lesser General Public License", "3")),
    "MIT": (_spdx("MIT"), "Released under the MIT License.", "The MIT License (MIT)", "MIT License", "Licensed under the MIT license.", f"MIT License {_GRANT} The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_NO_WARRANTY}"),
    "MPL-2.0": (_spdx("MPL-2.0"), "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Unlicense": (_spdx("Unlicense"), "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    "Zlib": (_spdx("Zlib"), "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely."),
}
