"""Licence phrases and notices, and their positional index (no Spark here; see
``licenses.py``)."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Phrases whose places are reported, and their labels.  Fixed values.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Licence notices: label, text, and the phrases that have to stand in it.
# Wordings of public licences and of their usual short forms.
NOTICES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0.", ["apache license", "version 2 0"]),
    ("apache-2.0",
     "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
     "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
     ["apache license", "version 2 0"]),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3.",
     ["gnu general public license", "version 3"]),
    ("gpl-3.0",
     "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version.", ["gnu general public license", "version 3"]),
    ("gpl-2.0",
     "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
     "option) any later version.", ["gnu general public license", "version 2"]),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0.", ["cc by nc 4 0"]),
    ("cc-by-4.0", "Licensed under CC BY 4.0.", ["cc by 4 0"]),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0.", ["cc by sa 4 0"]),
    ("mit", "Released under the MIT License.", ["mit license"]),
    ("mit",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the Software), to deal in the Software without restriction",
     ["permission is hereby granted free of charge"]),
    ("bsd-3-clause",
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("agpl-3.0",
     "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
     "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
     "your option) any later version.", ["gnu affero general public license", "version 3"]),
    ("artistic-2.0", "Licensed under the Artistic License 2.0.", ["artistic license 2 0"]),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0.", ["boost software license", "version 1 0"]),
    ("bsl-1.0",
     "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
     "and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, "
     "execute, and transmit the Software", ["any person or organization obtaining a copy"]),
    ("cc-by-nc-nd-4.0", "Licensed under CC BY-NC-ND 4.0.", ["cc by nc nd 4 0"]),
    ("cc-by-nc-sa-4.0", "Licensed under CC BY-NC-SA 4.0.", ["cc by nc sa 4 0"]),
    ("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0.", ["cc by nd 4 0"]),
    ("cc-by-4.0",
     "This work is licensed under a Creative Commons Attribution 4.0 International License.",
     ["creative commons attribution 4 0"]),
    ("cc-by-sa-4.0",
     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
     ["creative commons attribution sharealike 4 0"]),
    ("cc0-1.0",
     "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this "
     "work.", ["waived all copyright and related or neighboring rights"]),
    ("cddl-1.0",
     "The contents of this file are subject to the terms of the Common Development and Distribution License (the "
     "License). You may not use this file except in compliance with the License.",
     ["common development and distribution license"]),
    ("epl-2.0",
     "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
     "2.0", ["eclipse public license 2 0"]),
    ("epl-1.0",
     "All rights reserved. This program and the accompanying materials are made available under the terms of the "
     "Eclipse Public License v1.0", ["eclipse public license v1 0"]),
    ("eupl-1.2", "Licensed under the EUPL, Version 1.2.", ["the eupl version 1 2"]),
    ("gfdl-1.3",
     "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free "
     "Documentation License, Version 1.3 or any later version published by the Free Software Foundation",
     ["gnu free documentation license", "version 1 3"]),
    ("isc",
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies.",
     ["for any purpose with or without fee is hereby granted"]),
    ("lgpl-2.1",
     "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
     "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
     "your option) any later version.", ["gnu lesser general public license", "version 2 1"]),
    ("lgpl-3.0",
     "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
     "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
     "your option) any later version.", ["gnu lesser general public license", "version 3"]),
    ("mpl-2.0",
     "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
     "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
     ["mozilla public license v 2 0"]),
    ("odbl-1.0",
     "This database is made available under the Open Database License: http://opendatacommons.org/licenses/odbl/1.0/.",
     ["open database license"]),
    ("ofl-1.1",
     "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
     ["sil open font license", "version 1 1"]),
    ("unlicense",
     "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
     "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
     "for any purpose, commercial or non-commercial, and by any means.",
     ["free and unencumbered software released into the public domain"]),
    ("zlib",
     "This software is provided as-is, without any express or implied warranty. In no event will the authors be held "
     "liable for any damages arising from the use of this software.",
     ["in no event will the authors be held liable"]),
]
#: Highest-IDF words of a template that a file looks up.
RARE_WORDS = 4
#: Share of a notice's words that have to stand in place.
SHARE = 0.6
#: Words by which a key phrase may be shifted against its notice.
SLACK = 2


def words(text: str | None) -> list[bytes]:
    """Words after lower-casing A-Z: digits, letters and non-ASCII characters."""
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    #: Places of the mandatory phrases: (start, words).
    keys: tuple[tuple[int, tuple[bytes, ...]], ...]
    #: All words have to stand in place, and every place counts.
    phrase: bool


def _template(label: str, text: str, keys: list[str], phrase: bool) -> Template:
    own = tuple(words(text))
    places = []
    for key in keys:
        k = tuple(words(key))
        places.append((next(i for i in range(len(own)) if own[i : i + len(k)] == k), k))
    return Template(label, own, tuple(places), phrase)


TEMPLATES = [_template(label, p, [p], True) for p, label in PHRASES.items()] + [
    _template(label, text, keys, False) for label, text, keys in NOTICES
]
#: All words whose document frequencies the index needs.
VOCABULARY = sorted({w for t in TEMPLATES for w in t.words})


class Index:
    """Positional postings of the templates' rarest words."""

    def __init__(self, idf: dict[bytes, float], templates: list[Template] = TEMPLATES):
        self.templates = templates
        self.rare: list[list[tuple[bytes, list[int]]]] = []
        for t in templates:
            order = sorted(set(t.words), key=lambda w: (-idf.get(w, 0.0), w))
            self.rare.append([(w, [i for i, x in enumerate(t.words) if x == w]) for w in order])
        # a phrase is found by its rarest word alone, as all its words must be there
        self.wanted = {
            w for t, rare in zip(templates, self.rare) for w, _ in (rare[:1] if t.phrase else rare[: 2 * RARE_WORDS])
        }

    def scan(self, text: str | None) -> dict:
        """The places of the phrases and the notices of one text."""
        found = words(text)
        places: dict[bytes, list[int]] = {}
        wanted = self.wanted
        for i, w in enumerate(found):
            if w in wanted:
                places.setdefault(w, []).append(i)
        base: list[tuple[int, str]] = []
        labels: list[str] = []
        best = 0.0
        for t, rare in zip(self.templates, self.rare) if places else ():
            if t.phrase:
                word, own = rare[0]
                for at in places.get(word, ()):
                    for p in own:
                        start = at - p
                        if start >= 0 and tuple(found[start : start + len(t.words)]) == t.words:
                            base.append((start, t.label))
                            best = 1.0
                continue
            # the file's highest-IDF words of this notice vote for relative positions
            present = [(w, own) for w, own in rare[: 2 * RARE_WORDS] if w in places][:RARE_WORDS]
            if len(present) < 2:
                continue
            votes = Counter(at - p for w, own in present for at in places[w] for p in own)
            for start, n in votes.items():
                if n < 2:
                    continue
                same = sum(
                    0 <= start + i < len(found) and found[start + i] == w for i, w in enumerate(t.words)
                ) / len(t.words)
                best = max(best, same)
                if same >= SHARE and all(_near(found, start + i, key) for i, key in t.keys):
                    labels.append(t.label)
        base_labels = sorted({label for _, label in base})
        starts = sorted({(s, label) for s, label in base})
        return {
            "n_words": len(found),
            "places": [s for s, _ in starts],
            "base_labels": base_labels,
            "labels": sorted({*base_labels, *labels}),
            "score": best,
        }


def _near(found: list[bytes], at: int, key: tuple[bytes, ...]) -> bool:
    return any(
        tuple(found[s : s + len(key)]) == key for s in range(max(0, at - SLACK), at + SLACK + 1)
    )
