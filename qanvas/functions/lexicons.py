"""Fixed values that results depend on: keyword lists, patterns and names. Stated as data; nothing here is logic."""

#: Substrings that mark front and back matter. "ISBN" is upper case and never matches lowered text; it is kept as given.
IRRELEVANT = [
    "copyright", "ISBN", "publisher", "permission", "disclaimer", "all rights reserved",
    "reproduction", "permission required", "for educational use only",
    "appendix", "bibliography", "terms and conditions", "privacy policy", "trademark", "advertisement",
    "footnote", "terms of use", "legal notice", "author biography", "editorial note", "foreword",
    "publication date", "previous editions", "contributor", "acknowledgement",
    "funding disclosure", "license", "disclosure statement", "author note",
    "supporting information", "recommended readings", "learning objectives", "key terms",
]

#: Substrings of lowered text that speak for a question type.
LIST_WORDS = [
    "include", "consist", "list", "examples", "such as", "contains", "types of", "categories",
    "components", "enumerate", "group", "varieties", "kinds of", "different types", "comprises",
]
CHOICE_WORDS = [
    "option", "choice", "select", "following", "correct answer", "quiz", "test", "exam",
    "multiple-choice", "choose", "best answer", "most likely", "which of these", "distractors", "responses",
]
TRUTH_WORDS = [
    "true", "false", "fact", "statement", "correct", "incorrect", "yes or no", "valid", "invalid",
    "agree", "disagree", "always", "never", "right or wrong", "affirmative",
]
SHORT_WORDS = [
    "who", "what", "where", "when", "how many", "how much", "define", "describe", "identify",
    "name", "explain", "mention", "summarize", "tell me about", "state",
]
REASON_WORDS = [
    "reasoning", "cause", "effect", "conclusion", "linked", "sequence", "dependencies",
    "relationship", "process", "interconnected", "logic", "rationale", "progression", "inference",
]

#: Alternations, matched without regard to case, of the older scorers. "dependencies", which stood there twice, is
#: listed once: the alternation matches the same texts.
V1_CHOICE = "option|choice|select|choose|correct answer|following"
V2_CHOICE = "option|choice|select|following|correct answer|choose|questionnaire|quiz"
V2_REASON = (
    "reasoning|steps|cause|effect|conclusion|linked|sequence|dependencies|relationship|process|interconnected|logic|rationale|"
    "pathway|progression|correlation|connections|inference|derivation|justification|explanation|analysis|causal|chain|flow|"
    "interaction|association|linkages|framework|structure|integration|contextual|stepwise|systematic|hierarchical|multi-step|dynamic"
)
#: Entity labels that speak for a short question in the second scorer.
NAMED_LABELS = ["DATE", "PERSON", "ORG", "GPE", "NORP", "EVENT"]

#: Question types in the order that breaks ties, and the balance category of each.
TYPES = ["short", "tf", "list", "mc", "multi_hop", "short_inverse", "multi_hop_inverse"]
CATEGORY = {"short": "short", "tf": "tf", "list": "list", "mc": "mc", "multi_hop": "multi_hop", "short_inverse": "short", "multi_hop_inverse": "multi_hop"}
CATEGORIES = ["short", "tf", "list", "mc", "multi_hop"]

#: File prefixes of saved question files, by type.
FILE_PREFIX = {"short": "short", "tf": "TF", "list": "list", "mc": "MC", "multi_hop": "multi_hop", "multi_hop_inverse": "multi_hop_inverse", "short_inverse": "short_inverse"}

#: Markers around generated text.
START_MARK, END_MARK = "<startofQAtext>", "<endofQAtext>"
PLACEHOLDER = "{paragraph_text}"
#: Suffixes that may follow an apostrophe in a word.
APOSTROPHE_ENDS = ["t", "nt", "s", "ll"]
#: Neighbours of a mask at the ends of a text.
BEFORE_TEXT, AFTER_TEXT = "beforeanytext", "afteralltext"
DEFAULT_OPTIONS = ["Option A", "Option B", "Option C"]
