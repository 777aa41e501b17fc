"""One combined stop-word list for block scoring (fixed values).

Common function words of the four languages in the data (English, French,
German, Spanish), lower case, letters only, in alphabetical order per
language. A word counts as a stop word when, lower-cased and stripped of
every non-letter, it is in this list.
"""

# English.
EN = (
    "a", "about", "after", "all", "also", "an", "and", "any", "are", "as", "at",
    "be", "because", "been", "but", "by", "can", "could", "did", "do", "does",
    "for", "from", "had", "has", "have", "he", "her", "his", "how", "i", "if",
    "in", "into", "is", "it", "its", "more", "most", "no", "not", "of", "on",
    "one", "only", "or", "other", "our", "out", "she", "so", "some", "than",
    "that", "the", "their", "them", "then", "there", "these", "they", "this",
    "to", "up", "was", "we", "were", "what", "when", "which", "who", "will",
    "with", "would", "you",
)

# French.
FR = (
    "au", "aux", "avec", "ce", "ces", "cette", "dans", "de", "des", "du", "elle",
    "en", "est", "et", "il", "ils", "je", "la", "le", "les", "leur", "lui", "mais",
    "mes", "nous", "on", "ont", "ou", "par", "pas", "plus", "pour", "qui", "que",
    "sa", "se", "ses", "son", "sont", "sur", "un", "une", "vous",
)

# German.
DE = (
    "auch", "auf", "aus", "bei", "das", "dass", "dem", "den", "der", "des", "die",
    "ein", "eine", "einem", "einen", "einer", "er", "es", "für", "hat", "ich",
    "ist", "mit", "nach", "nicht", "noch", "oder", "sich", "sie", "sind", "und",
    "von", "vor", "war", "wie", "wir", "wird", "zu", "zum", "zur",
)

# Spanish.
ES = (
    "al", "como", "con", "del", "el", "ella", "ellos", "entre", "es", "esta",
    "este", "fue", "ha", "las", "lo", "los", "más", "muy", "para", "pero", "por",
    "se", "sin", "sobre", "su", "sus", "también", "una", "uno", "y", "ya",
)

STOP_WORDS = tuple(sorted(set(EN + FR + DE + ES)))
