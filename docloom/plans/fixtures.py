"""Literal inputs of the queries on formats that the test tables lack."""

from __future__ import annotations

FILES = [(x,) for x in (
    "Manuale_Operativo_IVA_2025_Digitale.md", "Guida_PRIVACY_2024.md", "Ammortamenti_2023_PS.md", "Cedolino_e_Paghe.md", "Certificazione_CU_2025.md", "CU_2025.md",
    "Bilancio_2022_abbreviato_UO.md", "Antiriciclaggio.md", "INPS_contributi_2021.md", "Locazioni_brevi_2024.md", "Terzo_Settore_2023.md", "ETS_2023.md", "GDPR.md", "Visite_ISA_2020.md", "altro_tema.md",
)]

# The last column is what the rules give, worked out by hand.
NUMBERS = [
    (1, "Versare € 1.234,56 entro 30 giorni.", "30 giorni|€ 1234.56"), (2, "Art. 10-bis e Articolo 5 del D.Lgs. 231/2001", "2001|art. 10|art. 5|articolo 10|articolo 5|d.lgs. 231/2001"),
    (3, "Il 22 % o il 10 per cento", "10 per cento|10%|22 %"), (4, "il 3 marzo 2024, pari a 100 EUR", "100 eur|2024|3 marzo 2024"), (5, "comma 2, L. 104/92", "comma 2|l. 104/92"),
    (6, "nessun numero", ""), (7, "2,5 anni e 007 rate", "007 rate|2 anni|2.5 anni|7 rate"),
]

TABLES = [
    (1, "a <table><tr><td>1</td></tr></table> b"), (2, "a <table><tr> <table border=1><tr></table> b"), (3, "a <table><tr><td>1"), (4, "x </table> y </table> <table>1</table> z"),
    (5, "no table"), (6, "<TABLE>1</TABLE>\n<table>2"),
]

REPAIRED = [
    (1, "a <table><tr><td>1</td></tr></table> b"), (2, "a <table><tr> </table>\n<table border=1><tr></table> b"), (3, "a <table><tr><td>1\n</table>"),
    (4, "x </table> y </table> <table>1</table> z"), (5, "no table"), (6, "<TABLE>1</TABLE>\n<table>2\n</table>"),
]
BALANCED = [
    (1, "a <table><tr><td>1</td></tr></table> b"), (2, "a <table><tr> <table border=1><tr></table> b\n</table>"), (3, "a <table><tr><td>1\n</table>"),
    (4, "xy<table>1</table> z"), (5, "no table"), (6, "<TABLE>1</TABLE>\n<table>2\n</table>"),
]

TITLES = [(x,) for x in (
    "## Introduzione", "## **Avvertenza**", "## Istruzioni per attivare il codice", "## 1. Ambito", "## Sezione generale", "## La registrazione dei contratti", "## _Note legali_",
    "## Detrazioni ... 12", "## Aliquote", "## Indice", "## Centro Studi", "## Come usare il manuale", "## Autori", "## Codice di attivazione", "## E-book gratuito", "## Calcolo dell'imposta",
)]

MARKDOWN = [
    ("A_2024.md", "# A\n\nprima\n## Page 1\n\ntesto uno\n\n---\n\n## Aliquote\ncorpo aliquote senza punto\n## Page 2\n\ncontinua qui.\n## Page 3\n\naltra pagina\n## Esenzioni\nfine"),
    ("B.md", "# INDICE\n## Parte prima .... 3\nuno .... 4\n## Capitolo due\n## Page 1\nresto\n## Aliquote\ncorpo\n## Detrazioni 12\nin corso\n## Page 2\n# INDICE\nvoci\n## Calcolo\nnuovo corpo"),
    ("C.md", "## Indice\nvoci .... 2\n## Ambito\ntesto # indice in mezzo\n## Regole\ncorpo <table>\n## non titolo\n</table> dopo"),
]

#: The state machine run by hand over MARKDOWN: source, pos, is_page, in_toc, page.
STATES = [
    ("A_2024.md", 0, False, False, "N/A"), ("A_2024.md", 1, True, False, "1"), ("A_2024.md", 2, False, False, "1"), ("A_2024.md", 3, True, False, "2"),
    ("A_2024.md", 4, True, False, "3"), ("A_2024.md", 5, False, False, "3"),
    ("B.md", 0, False, True, "N/A"), ("B.md", 1, False, True, "N/A"), ("B.md", 2, False, True, "N/A"), ("B.md", 3, True, True, "1"), ("B.md", 4, False, False, "1"),
    ("B.md", 5, False, False, "1"), ("B.md", 6, True, True, "2"), ("B.md", 7, False, False, "2"),
    ("C.md", 1, False, True, "N/A"), ("C.md", 2, False, False, "N/A"), ("C.md", 3, False, False, "N/A"),
]

SENTENCES = [
    (1, "Uno. Due! Tre? Quattro", "Uno.|Due!|Tre?|Quattro"), (2, "Vedi art. 10 e poi. Basta.", "Vedi art. 10 e poi.|Basta."), (3, "Il dott. Rossi parla. Fine.", "Il dott.|Rossi parla.|Fine."),
    (4, "", ""), (5, "senza fine", "senza fine"), (6, "Ecco. *Corsivo.* Altro", "Ecco.|*Corsivo.* Altro"),
]

RESPONSES = [
    (0, '{"mixed_qas": [{"type": "def", "q": "Quanto vale?", "a": "Molto"}, {"q": "Il 22% si applica?", "a": "si"}], "paraphrase": " testo "}'),
    (1, '```json\n{"simple_qas": [{"q": "Chi?", "a": "Lui"}], "complex_qas": [{"q": "Entro 30 giorni?", "a": "Si, 30 giorni"}]}\n```'),
    (2, 'Ecco: {"multi_hop_qas": [{"q": "A?", "a": "B"}, {"q": "", "a": "C"}], "evolution_qas": []} fine'),
    (3, "non json"),
    (4, '{"mixed_qas": [], "simple_qas": [{"q": " Dove? ", "a": " Qui "}], "paraphrase": ""}'),
]
