"""Codes, marker patterns, bases and limits. Everything that uses them takes them as a parameter."""

from __future__ import annotations

#: Taxonomy order of function codes; also the order in a notation.
FUNCTIONS = "A K O F Y D Q P R E H G C B X T M L Z S I U V N".split()
CERTAINTY_SYMBOLS = {"none": "", "strong": "!", "tentative": "~", "uncertain": "?"}
STANCE_SYMBOLS = {"positive": "+", "negative": "-", "mixed": "±", "neutral": "0"}
EMOTIONS = "N A L C S E M T D F I".split()
VERSION = "v1_0"

# Segmentation
MAX_UNIT_CHARS = 280
SENTENCE_BOUNDARY = r"(?<=[.!?;:])(?U)\s+(?=[A-ZÁÉÍÓÚÜÑ¿¡0-9])"
SOFT_BOUNDARY = r"(?iU)\s+(?=(?:pero|aunque|porque|entonces|sin embargo|por eso|además|luego|después)\b)"
COMMA_BOUNDARY = r"(?<=,)(?U)\s+"

#: code, rule id, confidence, patterns on folded text in order of precedence, patterns that switch the rule off
FUNCTION_RULES: tuple[tuple[str, str, float, tuple[str, ...], tuple[str, ...]], ...] = (
    ("D", "function:D.evidence_marker", 0.82, (r"\d", "%", r"\bsegun\b", r"\bestudio\b", r"\bencuesta\b", r"\bdatos?\b", r"\breporte\b", r"\binforme\b"), ()),
    ("Y", "function:Y.causal_marker", 0.78, (r"\bporque\b", r"\bdebido a\b", r"\bla razon es\b", r"\bpor eso\b"), ()),
    ("E", "function:E.example_marker", 0.8, (r"\bpor ejemplo\b", r"\bimagina\b", r"\bsupongamos\b"), ()),
    ("H", "function:H.story_marker", 0.78, (r"\buna vez\b", r"\bme paso\b", r"\brecuerdo que\b"), ()),
    ("G", "function:G.analogy_marker", 0.78, (r"\bes como\b", r"\bfunciona como\b", r"\bparecido a\b"), ()),
    ("C", "function:C.contrast_marker", 0.72, (r"\bpero\b", r"\bsin embargo\b", r"\baunque\b", r"\ben cambio\b"), (r"\bpero bueno\b",)),
    ("B", "function:B.objection_marker", 0.84, (r"\balguien podria decir\b", r"\bse podria objetar\b", r"\bpodrian objetar\b"), ()),
    ("X", "function:X.risk_marker", 0.82, (r"\bcuidado\b", r"\bojo\b", r"\briesgo\b", r"\bpeligro\b"), ()),
    ("S", "function:S.solution_marker", 0.78, (r"\bte recomiendo\b", r"\bconviene\b", r"\bdeberias\b"), ()),
    ("I", "function:I.clear_imperative", 0.76, (r"^(haz|prueba|usa|evita|mide|elige|cambia|anota|recuerda|compara|revisa)\b",), ()),
    ("U", "function:U.utility_marker", 0.78, (r"\bla leccion\b", r"\baprendizaje\b", r"\btakeaway\b"), ()),
    ("V", "function:V.viewer_address", 0.7, (r"\btu caso\b", r"\bpreguntate\b", r"\btu\b", r"\bte\b", r"\bustedes\b"), ()),
    ("O", "function:O.opinion_marker", 0.8, (r"\bcreo\b", r"\bpienso\b", r"\bme parece\b"), ()),
    ("F", "function:F.definition_marker", 0.8, (r"\bsignifica\b", r"\bse define\b", r"\bes decir\b"), ()),
    ("L", "function:L.list_marker", 0.76, (r"\bprimero\b", r"\bsegundo\b", r"\btercero\b"), ()),
    ("M", "function:M.metacommentary_marker", 0.78, (r"\bvoy a explicar\b", r"\bdejame explicar\b", r"\bte explico\b"), ()),
    ("Q", "function:Q.explicit_quote", 0.82, (r'"[^"]+"', r"\bdijo:\b", r"\bcito\b", r"\bcita\b"), ()),
)
QUESTION_RULE = "function:P.question_mark"
CONCLUSION_RULE, CONCLUSION_PATTERNS = "function:Z.conclusion_marker", (r"\ben resumen\b", r"\ben conclusion\b", r"\bpara cerrar\b")
LOCKED_CONFIDENCE, CONCLUSION_CONFIDENCE, NEAR_END = 0.95, 0.78, 3

#: value, patterns
CERTAINTY = (("strong", (r"\bsin duda\b", r"\bclaramente\b", r"\bdefinitivamente\b")), ("tentative", (r"\bquizas\b", r"\btal vez\b", r"\bprobablemente\b")), ("uncertain", (r"\bno se\b", r"\bes incierto\b", r"\bdudo\b")))
STANCE = (("positive", (r"\bes valioso\b", r"\bfunciona bien\b", r"\bes mejor\b")), ("negative", (r"\bfalla\b", r"\bproblema grave\b", r"\bes peligroso\b")))
EMOTION_EXPRESSED = (
    ("A", (r"\bme alegra\b", r"\bestoy feliz\b", r"\bme entusiasma\b")),
    ("L", (r"\badmiro\b", r"\bme encanta\b")),
    ("C", (r"\bconfio\b", r"\bme da calma\b", r"\bestoy tranquilo\b")),
    ("S", (r"\bme sorprende\b", r"\bque sorpresa\b")),
    ("E", (r"\bme indigna\b", r"\bme enoja\b", r"\bestoy furioso\b")),
    ("M", (r"\bme preocupa\b", r"\btengo miedo\b", r"\bme da miedo\b")),
    ("T", (r"\bme entristece\b", r"\bque triste\b")),
    ("D", (r"\bme da asco\b", r"\bdesprecio\b")),
    ("F", (r"\bme frustra\b", r"\bestoy resignado\b")),
    ("I", (r"\bclaro, como si\b", r"\bsarcasmo\b")),
)
#: accented word, code; folded for heuristics, as they are for validation
EMOTION_WORDS = (
    ("alegría", "A"), ("entusiasmo", "A"), ("amor", "L"), ("admiración", "L"), ("calma", "C"), ("confianza", "C"), ("sorpresa", "S"),
    ("asombro", "S"), ("enojo", "E"), ("indignación", "E"), ("miedo", "M"), ("ansiedad", "M"), ("tristeza", "T"), ("decepción", "T"),
    ("disgusto", "D"), ("desprecio", "D"), ("frustración", "F"), ("resignación", "F"), ("ironía", "I"), ("sarcasmo", "I"),
)
MENTION_CONTEXT = r"\b(gente|personas|usuarios|ellos|alguien|menciona|habla de|siente|sienten|sentir)\b"
MENTION_BEFORE, MENTION_AFTER = 45, 20

# Validation
EVIDENCE_MARKERS = ("%", "según", "reporte", "informe", "dato", "medimos", "muestra", "registr", "encuesta", "tabla", "log")
OVERLABELLED = 5

# Relations: substrings of lower(text + " " + normalized_text)
MARKERS = {
    "CAUSAL": ("porque", "por eso", "debido", "se debe", "provoca", "causa", "cuando"),
    "QUESTION": ("?", "¿", "por qué", "para qué", "qué ", "cómo ", "cuándo "),
    "CONTRAST": ("pero", "sin embargo", "aunque", "en cambio", "mientras"),
    "REFUTATION": ("no es cierto", "refuta", "desmiente", "falso", "en realidad"),
    "RISK": ("riesgo", "peligro", "podría fallar", "puede romper", "amenaza"),
    "SOLUTION": ("solución", "recomiendo", "conviene", "deberíamos", "propongo"),
    "CONDITION": ("si ", "en caso de", "siempre que", "a condición"),
}
ANSWER_STARTS = ("la respuesta", "respuesta:", "porque", "es que")
MAX_DISTANCE, MIN_CONFIDENCE, STEP_PENALTY = 3, 0.58, 0.08

# Chains: type, relation types, base score
RELATION_CHAINS = (
    ("question_answer", ("ANS",), 0.9),
    ("claim_support_explanation", ("SUP", "EXPL", "CAUSE"), 0.82),
    ("risk_solution", ("RISK", "SOLV"), 0.88),
    ("contrast_resolution", ("CONTR", "REFUT", "SOLV", "SUM"), 0.78),
    ("example_or_analogy", ("EXMP", "ANLG", "ELAB"), 0.72),
)
#: type, accepted codes of each step, score
SEQUENCE_CHAINS = (
    ("problem_solution_call_sequence", (("X",), ("S", "I", "U"), ("V",)), 0.78),
    ("claim_evidence_explanation_sequence", (("A", "K", "O"), ("D", "Q"), ("Y", "E")), 0.76),
    ("contrast_resolution_sequence", (("A", "K", "O"), ("C", "B"), ("S", "Z")), 0.74),
    ("procedural_sequence", (("L", "T"), ("I",), ("U", "S", "Z")), 0.7),
)
CHAIN_PURPOSES = {
    "question_answer": "resuelve una pregunta explícita con una respuesta cercana",
    "claim_support_explanation": "sostiene o explica un claim con evidencia o causalidad",
    "risk_solution": "presenta un riesgo y lo conecta con una solución",
    "contrast_resolution": "contrasta u objeta una idea y ofrece cierre o resolución",
    "example_or_analogy": "desarrolla una idea mediante ejemplo, analogía o elaboración",
    "problem_solution_call_sequence": "mueve del riesgo a una recomendación y una llamada al espectador",
    "claim_evidence_explanation_sequence": "conecta claim, soporte y explicación o ejemplo",
    "contrast_resolution_sequence": "marca tensión narrativa y la cierra con solución o conclusión",
    "procedural_sequence": "ordena pasos o lista hacia utilidad, solución o cierre",
}
CHAIN_MIN_SCORE, CHAIN_LENGTH, CHAIN_GAP, CHAIN_REVIEW_PENALTY, CHAIN_REVIEW_BELOW = 0.58, 6, 2, 0.08, 0.72

# Similarity
SIMILARITY_THRESHOLD, SIMILARITY_TOP_K, EMBEDDING_SIZE = 0.82, 10, 128
VIEWER_ADDRESS = r"\b(tu|tus|te|ti|contigo|ustedes|preguntate)\b"

# What a conflict's explanation says.
EXPLANATIONS = {
    "viewer": "Difference is only viewer-call V and is supported by direct address.",
    "context": "R/Y difference is explained by a nearby question anchor for one unit.",
    "claims": "Very similar units differ across A/K/O boundary.",
    "emotion": "Possible confusion between expressed and mentioned emotion.",
    "other": "Similar units have materially different notation fields.",
}

# Review and committee
REVIEW_CONFUSION_GROUPS = (("A", "K", "O"), ("R", "Y"), ("D", "Q", "K"), ("E", "H", "G"), ("S", "I", "U"), ("C", "B", "X"), ("T", "M", "L", "Z"))
REVIEW_CONFIDENCE, REVIEW_INTENSITY, REVIEW_FUNCTIONS, QA_SAMPLE = 0.85, 3, 3, 10
AGREEMENT_GATE, CONFIDENCE_GATE, PROMOTION_FLOOR, REGRESSION_FLOOR = 0.67, 0.75, 0.8, 0.9
ADJUDICATION_CONFUSION_GROUPS = (("A", "K", "O"), ("R", "Y"), ("E", "H", "G"), ("S", "I", "U"), ("C", "B", "X"))
HIGH_RISK_FLAGS = ("D_without_evidence", "R_without_question_anchor", "possible_overlabeling")
ADJUDICATE_BELOW, ADJUDICATE_INTENSITY, ADJUDICATE_FUNCTIONS = 0.7, 3, 4
