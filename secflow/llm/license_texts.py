"""Texts and standard headers of common licences, without their copyright lines.

Full texts of the short licences; of the long ones the header that files carry, and the preamble of the GPL.
"""

BODIES = [
    ("MIT-text", (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and '
        'associated documentation files (the "Software"), to deal in the Software without restriction, '
        'including without limitation the rights to use, copy, modify, merge, publish, distribute, '
        'sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is '
        'furnished to do so, subject to the following conditions: The above copyright notice and this '
        'permission notice shall be included in all copies or substantial portions of the Software. THE '
        'SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        'LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '
        'IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER '
        'LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN '
        'CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. '
    )),
    ("BSD-2-Clause-text", (
        'Redistribution and use in source and binary forms, with or without modification, are permitted '
        'provided that the following conditions are met: 1. Redistributions of source code must retain the '
        'above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in '
        'binary form must reproduce the above copyright notice, this list of conditions and the following '
        'disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE '
        'IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
        'INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A '
        'PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE '
        'FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT '
        'NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR '
        'BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT '
        'LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS '
        'SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE. '
    )),
    ("BSD-3-Clause-text", (
        'Redistribution and use in source and binary forms, with or without modification, are permitted '
        'provided that the following conditions are met: 1. Redistributions of source code must retain the '
        'above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in '
        'binary form must reproduce the above copyright notice, this list of conditions and the following '
        'disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither '
        'the name of the copyright holder nor the names of its contributors may be used to endorse or promote '
        'products derived from this software without specific prior written permission. THIS SOFTWARE IS '
        'PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
        'INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A '
        'PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE '
        'FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT '
        'NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR '
        'BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT '
        'LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS '
        'SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE. '
    )),
    ("ISC-text", (
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee '
        'is hereby granted, provided that the above copyright notice and this permission notice appear in all '
        'copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS '
        'SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE '
        'AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES '
        'WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE '
        'OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS '
        'SOFTWARE. '
    )),
    ("Apache-2.0-header", (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        'compliance with the License. You may obtain a copy of the License at '
        'http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in '
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        'WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific '
        'language governing permissions and limitations under the License. '
    )),
    ("GPL-2.0-header", (
        'This program is free software; you can redistribute it and/or modify it under the terms of the GNU '
        'General Public License as published by the Free Software Foundation, either version 2 of the '
        'License, or (at your option) any later version. This program is distributed in the hope that it will '
        'be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS '
        'FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. '
    )),
    ("GPL-3.0-header", (
        'This program is free software: you can redistribute it and/or modify it under the terms of the GNU '
        'General Public License as published by the Free Software Foundation, either version 3 of the '
        'License, or (at your option) any later version. This program is distributed in the hope that it will '
        'be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS '
        'FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. '
    )),
    ("LGPL-3.0-header", (
        'This library is free software: you can redistribute it and/or modify it under the terms of the GNU '
        'Lesser General Public License as published by the Free Software Foundation, either version 3 of the '
        'License, or (at your option) any later version. This library is distributed in the hope that it will '
        'be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS '
        'FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. '
    )),
    ("AGPL-3.0-header", (
        'This program is free software: you can redistribute it and/or modify it under the terms of the GNU '
        'Affero General Public License as published by the Free Software Foundation, either version 3 of the '
        'License, or (at your option) any later version. This program is distributed in the hope that it will '
        'be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS '
        'FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. '
    )),
    ("GPL-3.0-preamble", (
        'The GNU General Public License is a free, copyleft license for software and other kinds of works. '
        'The licenses for most software and other practical works are designed to take away your freedom to '
        'share and change the works. By contrast, the GNU General Public License is intended to guarantee '
        'your freedom to share and change all versions of a program--to make sure it remains free software '
        'for all its users. We, the Free Software Foundation, use the GNU General Public License for most of '
        'our software; it applies also to any other work released this way by its authors. You can apply it '
        'to your programs, too. When we speak of free software, we are referring to freedom, not price. Our '
        'General Public Licenses are designed to make sure that you have the freedom to distribute copies of '
        'free software (and charge for them if you wish), that you receive source code or can get it if you '
        'want it, that you can change the software or use pieces of it in new free programs, and that you '
        'know you can do these things. To protect your rights, we need to prevent others from denying you '
        'these rights or asking you to surrender the rights. Therefore, you have certain responsibilities if '
        'you distribute copies of the software, or if you modify it: responsibilities to respect the freedom '
        'of others. For example, if you distribute copies of such a program, whether gratis or for a fee, you '
        'must pass on to the recipients the same freedoms that you received. You must make sure that they, '
        'too, receive or can get the source code. And you must show them these terms so they know their '
        'rights. Developers that use the GNU GPL protect your rights with two steps: (1) assert copyright on '
        'the software, and (2) offer you this License giving you legal permission to copy, distribute and/or '
        "modify it. For the developers' and authors' protection, the GPL clearly explains that there is no "
        "warranty for this free software. For both users' and authors' sake, the GPL requires that modified "
        'versions be marked as changed, so that their problems will not be attributed erroneously to authors '
        'of previous versions. Some devices are designed to deny users access to install or run modified '
        'versions of the software inside them, although the manufacturer can do so. This is fundamentally '
        "incompatible with the aim of protecting users' freedom to change the software. The systematic "
        'pattern of such abuse occurs in the area of products for individuals to use, which is precisely '
        'where it is most unacceptable. Therefore, we have designed this version of the GPL to prohibit the '
        'practice for those products. If such problems arise substantially in other domains, we stand ready '
        'to extend this provision to those domains in future versions of the GPL, as needed to protect the '
        'freedom of users. Finally, every program is threatened constantly by software patents. States should '
        'not allow patents to restrict development and use of software on general-purpose computers, but in '
        'those that do, we wish to avoid the special danger that patents applied to a free program could make '
        'it effectively proprietary. To prevent this, the GPL assures that patents cannot be used to render '
        'the program non-free. The precise terms and conditions for copying, distribution and modification '
        'follow. '
    )),
    ("MPL-2.0-header", (
        'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of '
        'the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/. '
    )),
    ("Unlicense-text", (
        'This is free and unencumbered software released into the public domain. Anyone is free to copy, '
        'modify, publish, use, compile, sell, or distribute this software, either in source code form or as a '
        'compiled binary, for any purpose, commercial or non-commercial, and by any means. '
    )),
    ("Zlib-text", (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the "
        'authors be held liable for any damages arising from the use of this software. Permission is granted '
        'to anyone to use this software for any purpose, including commercial applications, and to alter it '
        'and redistribute it freely, subject to the following restrictions: 1. The origin of this software '
        'must not be misrepresented; you must not claim that you wrote the original software. If you use this '
        'software in a product, an acknowledgment in the product documentation would be appreciated but is '
        'not required. 2. Altered source versions must be plainly marked as such, and must not be '
        'misrepresented as being the original software. 3. This notice may not be removed or altered from any '
        'source distribution. '
    )),
]
