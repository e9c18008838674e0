"""Texts and short notices of well-known public licences, to be looked up whole."""

from __future__ import annotations

_PERMISSION = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE."""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted"""
_ISC_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies"
_ISC_DISCLAIMER = """.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
USE OR PERFORMANCE OF THIS SOFTWARE."""

_BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission.
"""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN
ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to
alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.
If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is
not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.
3. This notice may not be removed or altered from any source distribution."""

_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License."""

#: (id, title or none, text)
LICENSES = [
    ("MIT", "MIT License", _PERMISSION),
    ("MIT", "The MIT License (MIT)", _PERMISSION),
    ("MIT", None, "Released under the MIT License."),
    ("ISC", "ISC License", _ISC_GRANT + _ISC_NOTICE + _ISC_DISCLAIMER),
    ("0BSD", "Zero-Clause BSD", _ISC_GRANT + _ISC_DISCLAIMER),
    ("BSD-2-Clause", "BSD 2-Clause License", _BSD_GRANT + _BSD_DISCLAIMER),
    ("BSD-3-Clause", "BSD 3-Clause License", _BSD_GRANT + _BSD_NAMES + _BSD_DISCLAIMER),
    ("Zlib", "zlib License", _ZLIB),
    ("Apache-2.0", None, _APACHE_HEADER),
    ("Apache-2.0", None, "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", None, "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", None, "Licensed under CC BY-NC 4.0."),
]

#: Digests of long texts: whole, and their terms without what follows, with and without the line that ends them.
DIGESTS: dict[str, list[str]] = {
    "Apache-2.0": [
        "b43ec2ad17dac2e4744f3f3503ef2879cbf43594c9f36e549257f45fde994f5e",
        "87da852f2fb0b4a4d8b9dea6264cb5fc07a9e06ee0fb3f119dccc45fa9efacc9",
        "ac4a852fd4fa95cbf3122b6779e338b6952a3b1a3116d5ca889ef0f23f2acdc0",
    ],
    "Artistic-1.0-Perl": [
        "d1ce9579b2c8d32b706b421d9c42208152298e00849e57ce7da8e906ed3802f2",
    ],
    "BSD-3-Clause": [
        "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651",
    ],
    "CC0-1.0": [
        "ee4f004efcecdf9d9069648b3868636b6aed9a7d8fa7a8319d5d5b4ac94ae44d",
    ],
    "GFDL-1.2": [
        "1c057ea35084eb195331cec1a49fca335c176422a7726a9a23636906fd4e241f",
    ],
    "GFDL-1.3": [
        "7e8edd3abe6258bb82bb853d91a0c24fcd9976894fd0592747354cffe1cb18e7",
    ],
    "GPL-1.0": [
        "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224",
        "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70",
        "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc",
    ],
    "GPL-2.0": [
        "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821",
        "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808",
        "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34",
    ],
    "GPL-3.0": [
        "586c3618658ef60aad1bc2ebb196d5ca77bda2718389a7bf943a62adc134b9fd",
        "f310206f3f5bdb0dc1db5acd3e265d6510a2ef6d887ca331f3f3a309d674204f",
        "a0aac2df95f0cdfe23c0177fcdd25b34f751eda4cb9f4c24af8bc2d487ae7043",
    ],
    "LGPL-2.0": [
        "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908",
        "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2",
        "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260",
    ],
    "LGPL-2.1": [
        "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891",
        "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df",
        "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4",
    ],
    "LGPL-3.0": [
        "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",
    ],
    "MPL-1.1": [
        "401f55b80eee09109112b0557b3dc1aa9e4e7379f1183ff1207ab655ec6b1f8a",
    ],
    "MPL-2.0": [
        "4a05bfd6c13b2d422d10ac14f7e6c672e2c3964895afc2bbc3878978501d6d85",
    ],
}
