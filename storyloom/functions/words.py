"""Default stop words.

The closed classes of English (articles, pronouns, prepositions, conjunctions,
auxiliaries and common adverbs) plus the pieces that contractions leave behind.
Every operator takes another list as a parameter.
"""

# Fixed values
_CLASSES = (
    # articles, determiners, quantifiers
    "a an the this that these those each every either neither both all any some no none such own same other another "
    "few less least many more most much several enough",
    # pronouns
    "i me my mine myself we us our ours ourselves you your yours yourself yourselves he him his himself she her hers "
    "herself it its itself they them their theirs themselves who whom whose which what",
    # prepositions
    "about above across after against along among around at before behind below beneath beside between beyond by down "
    "during for from in into of off on onto out over through to toward towards under until up upon via with within without",
    # conjunctions
    "and or but nor so yet because although though while whereas if unless whether than as since",
    # auxiliaries
    "am is are was were be been being have has had having do does did doing can could will would shall should may might must",
    # adverbs
    "not only also very too just then there here when where why how again once ever never always often almost still even "
    "further however",
    # what is left of contractions
    "s t d m ll re ve don didn doesn isn aren wasn weren hasn haven hadn couldn shouldn wouldn won ain",
)

STOP_WORDS: tuple[str, ...] = tuple(dict.fromkeys(" ".join(_CLASSES).split()))
