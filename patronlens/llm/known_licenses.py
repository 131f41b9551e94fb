"""The known licence texts: notices by which texts name their licence, and whole licences.

Notices are every lead-in times every name and version of a licence. Whole licences are read from ``license_texts``, each as it is
printed and with one line a paragraph; with and without its title, with and without what stands behind the end of its terms, with
numbered and with plain list items where it has few of them.
"""

from __future__ import annotations

import re
from pathlib import Path

LEADS = (
    "Licensed under",
    "Released under",
    "This work is licensed under",
    "This work is released under",
    "This software is licensed under",
    "This software is released under",
)


def _gnu(name: str, short: str, version: str) -> tuple[str, ...]:
    long = f"the GNU {name} General Public License".replace("  ", " ")
    numbers = {version, f"{version}.0"} if "." not in version else {version}
    names = [f"{start}{comma} version {n}" for start in (long, f"the GNU {short}") for comma in (",", "") for n in sorted(numbers)]
    return (*names, *(f"the GNU {short} {n}" for n in sorted(numbers)), *(f"the {short}-{n}" for n in sorted(numbers)))


def _creative_commons(parts: str, version: str) -> tuple[str, ...]:
    words = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
    long = "Creative Commons " + "-".join(words[part] for part in parts.split("-")) + f" {version}"
    kind = " International" if version == "4.0" else " Unported" if version == "3.0" else ""
    short = f"CC {parts} {version}"
    return (short, f"the {short} License", f"{long}{kind}", *(f"{a} {long}{k} License" for a in ("a", "the") for k in {kind, ""}))


NAMES = {
    "Apache-2.0": ("the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License", "Apache 2.0"),
    "MIT": ("the MIT License", "the MIT License (MIT)", "MIT"),
    "ISC": ("the ISC License",),
    "BSD-2-Clause": ("the BSD 2-Clause License", "the 2-Clause BSD License", "the Simplified BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("the BSD 3-Clause License", "the 3-Clause BSD License", "the New BSD License", "BSD-3-Clause"),
    "MPL-1.1": ("the Mozilla Public License, version 1.1", "the Mozilla Public License 1.1", "MPL 1.1"),
    "MPL-2.0": ("the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0", "MPL 2.0"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "the CC0 1.0 License", "Creative Commons Zero 1.0", "the Creative Commons CC0 1.0 Universal License"),
    "Unlicense": ("the Unlicense",),
    "Zlib": ("the zlib License",),
    "GPL-1.0": _gnu("", "GPL", "1"),
    "GPL-2.0": _gnu("", "GPL", "2"),
    "GPL-3.0": _gnu("", "GPL", "3"),
    "LGPL-2.0": _gnu("Library", "LGPL", "2"),
    "LGPL-2.1": _gnu("Lesser", "LGPL", "2.1"),
    "LGPL-3.0": _gnu("Lesser", "LGPL", "3"),
    "AGPL-3.0": _gnu("Affero", "AGPL", "3"),
    **{
        f"CC-{parts}-{version}": _creative_commons(parts, version)
        for parts in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0")
    },
}

TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", "The BSD 2-Clause License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", "The BSD 3-Clause License"),
    "Unlicense": ("The Unlicense", "Unlicense"),
    "Zlib": ("zlib License", "The zlib License"),
}

ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies.\n\n"
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
END = re.compile(r"^\s*(?:END OF TERMS AND CONDITIONS|Exhibit A - Source Code Form License Notice)\s*$", re.M)
ADDRESS = re.compile(r"^\s*51 Franklin St(?:reet)?, Fifth Floor, Boston, MA\s+02110-1301\s+USA\s*\n", re.M)


def whole_texts() -> dict[str, str]:
    """The whole licences by id, as they are printed."""
    texts = {path.stem: path.read_text("utf-8") for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
    return {"ISC": ISC, **texts}


def paragraphs(text: str) -> str:
    """A text with one line a paragraph or list item."""
    lines = re.sub(r"[ \t]*\n(?![ \t]*(?:\n|[*-]|\(?\w{1,2}[.)]\s))[ \t]*", " ", text)
    return re.sub(r"\n+ *", "\n", lines)


def variants(name: str, text: str) -> list[str]:
    """The forms in which a whole licence is handed on, as it is first."""
    forms = [text]
    if name == "ISC":
        forms.append(text.replace("and/or distribute", "and distribute"))
    if found := END.search(text):  # with the line that ends the terms, and without it
        forms += [text[: found.end()], text[: found.start()]]
    forms += [ADDRESS.sub("", form, count=1) for form in forms if ADDRESS.search(form)]
    if name == "CC0-1.0":
        forms.append(text.split("\n", 1)[1])
    if name in TITLES:
        forms += [re.sub(r"^ *\d\. ", "* ", form, flags=re.M) for form in forms if re.search(r"^ *\d\. ", form, re.M)]
        forms += [f"{title}\n\n{form}" for title in TITLES[name] for form in forms]
    forms += [paragraphs(form) for form in forms]
    return list(dict.fromkeys(forms))


def known_texts() -> dict[str, tuple[str, ...]]:
    """Whole licences and notices by licence id."""
    known = {name: variants(name, text) for name, text in whole_texts().items()}
    for name, called in NAMES.items():
        known.setdefault(name, []).extend(f"{lead} {one}." for one in dict.fromkeys(called) for lead in LEADS)
    return {name: tuple(texts) for name, texts in known.items()}
