"""Sixty paragraphs, written apart from the rules that the classifier learns from, and what licence they name."""

LABELLED = [
    ("agpl", "Our server component ships under the GNU Affero General Public License v3.0, see LICENSE."), ("agpl", "Released under AGPL-3.0"), ("agpl", "The code in this folder is licensed under AGPLv3."), ("agpl", "This program is distributed under GNU AGPL v3 terms"),
    ("apache", "Licensed under the Apache License, Version 2.0 by the contributors"), ("apache", "We use the Apache license"), ("apache", "Apache-2.0"), ("apache", "this crate is Apache-2.0 licensed"), ("apache", "The runtime is available under the Apache License 2.0 and nothing else"),
    ("boost", "Distributed under the Boost Software License, Version 1.0"), ("boost", "Header only, BSL-1.0 license"), ("bsd", "Use it under the BSD license"), ("bsd", "3-Clause BSD License applies"), ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by", "Text is available under the Creative Commons Attribution 4.0 International License"), ("cc-by", "Photos: CC BY 4.0"), ("cc-by-nc", "Licensed under CC BY-NC 4.0"), ("cc-by-nc", "This course is under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc-nd", "CC BY-NC-ND 4.0 for all drawings"), ("cc-by-nc-sa", "This work is licensed under the Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"), ("cc-by-nc-sa", "the slides are CC BY-NC-SA 4.0"), ("cc-by-nd", "Creative Commons Attribution-NoDerivatives 4.0 International License"), ("cc-by-nd", "shared as CC BY-ND 4.0"),
    ("cc-by-sa", "Content under CC BY-SA 4.0"), ("cc-by-sa", "This page is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"), ("cc0", "The data set is available under CC0 1.0"), ("cc0", "CC0 1.0 Universal"), ("epl", "Licensed under the Eclipse Public License 2.0"), ("epl", "EPL-2.0 for the plug-ins"),
    ("eupl", "Licensed under the EUPL-1.2"), ("eupl", "published under the European Union Public Licence 1.2"), ("gpl", "Copyright 2011 by the authors, licensed under the GNU General Public License v3.0"), ("gpl", "SPDX-License-Identifier: GPL-2.0-only"), ("gpl", "kernel modules are GPLv2"), ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("isc", "ISC License"), ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"), ("lgpl", "The library is under the GNU Lesser General Public License v3.0"), ("lgpl", "LGPL-3.0 license"), ("mit", "Code is MIT licensed"), ("mit", "Released under the MIT License by its author"), ("mit", "SPDX-License-Identifier: MIT"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"), ("mpl", "Covered by the Mozilla Public License 2.0"), ("mpl", "MPL-2.0"), ("proprietary", "All rights reserved."), ("proprietary", "Copyright 2020 Example Inc. All rights reserved."), ("public-domain", "This work is in the public domain."),
    (None, "All rights reserved by the committee for the annual meeting"), (None, "Licensed under the Zope Public License 2.1"), (None, "Use of this font is under the SIL Open Font License"), (None, "Distributed under the Artistic License 2.0"), (None, "He lost his driving licence near the apache reservation"), (None, "Students at MIT asked for permission to enter"),
    (None, "The licence fee pays for public broadcasting"), (None, "the mozilla office in the eclipse of monday"), (None, "Creative people on the commons, with due attribution to the choir"), (None, "We reserve all rights to change the menu"), (None, "A general public meeting about free software took place"), (None, "version 2.0 of the contract is under negotiation"),
]


def test_sixty_paragraphs(spark):
    from postloom.llm import license_scan

    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(LABELLED)], "doc_id long, text string")
    got = {r.doc_id: r.families for r in license_scan.license_scan(docs).collect()}
    wrong = [(f, got[i], t) for i, (f, t) in enumerate(LABELLED) if got[i] != (f or "")]
    assert len(LABELLED) == 60 and not [w for w in wrong if w[1]], wrong  # never another family
    assert len(wrong) <= 2, wrong


def test_paragraphs_that_go_to_unknown_are_counted(spark):
    from postloom.llm import license_scan

    rows = [(1, "Licensed under the Zope Public License\n\nReleased under the MIT License.\n\nxyz qqq"), (2, None), (3, "")]
    got = {r.doc_id: r for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_notices, got[1].families, got[1].n_unconfirmed, got[1].n_unknown) == (1, "mit", 0, 1)
    assert all((got[i].n_notices, got[i].n_unknown) == (0, 0) for i in (2, 3))
