"""Word lists of the rule backend.

Small and fixed on purpose: they become literals of the plan. They stand in for
a model so that a run needs none; they do not reach its quality.
"""

from __future__ import annotations

# emotion -> words, by polarity
POSITIVE_EMOTIONS = {
    "joy": "best better great good love lovely happy win wins fun delight amazing awesome "
           "wonderful excellent fantastic perfect beautiful brilliant enjoy",
    "calm": "rest safe peace gentle relax comfort easy",
    "trust": "thanks thank recommend reliable honest helpful support",
    "anticipation": "hope excited exciting bright promising",
}
NEGATIVE_EMOTIONS = {
    "anger": "hate angry furious terrible awful horrible idiot moron scum rage",
    "disgust": "trash disgusting gross nasty worthless pathetic",
    "sadness": "sad tire tired loser cry lonely lost miss hurt",
    "fear": "threat afraid scared danger panic worry sting",
    "disappointment": "bad worse worst poor broken fail failed stupid boring clown",
}

# category -> sub-category -> words; "Other" has none
TOPICS = {
    "Technology": {"software": "software app code linux apache gnu licensed license render",
                   "hardware": "phone laptop chip computer robot heater",
                   "internet": "internet web online browser wifi"},
    "Business": {"finance": "bank stock market invest money price fund",
                 "property": "rent rental lease mortgage",
                 "companies": "company startup business revenue profit"},
    "Entertainment": {"screen": "movie film series actor cinema",
                      "music": "music song album concert singer sting"},
    "Sports": {"ball": "football soccer basketball cricket tennis goal",
               "competition": "match league team coach olympics"},
    "Politics": {"government": "government minister parliament president senate policy",
                 "elections": "election vote campaign"},
    "Health": {"medicine": "doctor hospital vaccine medicine patient",
               "wellbeing": "health fitness sleep diet rest"},
    "Science": {"physics": "physics energy heat quantum particle",
                "research": "science research experiment study space"},
    "Lifestyle": {"home": "home garden recipe cooking shed",
                  "travel": "travel hotel beach holiday tour",
                  "fashion": "fashion style beauty dress"},
    "Education": {"school": "school student teacher class exam test",
                  "university": "university degree course lecture college"},
}
INDUSTRIES = {
    "Technology": "Information Technology", "Business": "Financial Services",
    "Entertainment": "Media", "Sports": "Sports", "Politics": "Public Sector",
    "Health": "Healthcare", "Science": "Research", "Lifestyle": "Consumer Goods",
    "Education": "Education", "Other": "Unknown",
}
COMMERCIAL = "buy sale discount offer deal shop promo rent subscribe order coupon"
NEWS = "breaking report reports reported announced official update east headline"

# flag -> words
MODERATION = {
    "hate_speech": "bigot racist subhuman",
    "violence": "kill attack murder threat shoot bomb",
    "adult_content": "nsfw porn xxx nude",
    "spam": "giveaway viagra casino clickbait lottery",
    "misinformation": "hoax fake conspiracy debunked",
    "profanity": "damn crap bloody",
    "harassment": "trash pathetic idiot worthless disgusting stupid clown scum loser moron",
}
WARNINGS = {
    "hate_speech": "hateful language", "violence": "violent language",
    "adult_content": "adult language", "spam": "likely unsolicited promotion",
    "misinformation": "disputed claim", "profanity": "coarse language",
    "harassment": "personal attack",
}

# lower-case phrases of one to three words
GAZETTEER = {
    "people": ["ada lovelace", "alan turing", "grace hopper", "linus torvalds",
               "marie curie", "nelson mandela"],
    "organizations": ["apache", "gnu", "mit", "nasa", "unesco", "united nations",
                      "world bank", "european union"],
    "locations": ["london", "paris", "berlin", "madrid", "mumbai", "new york",
                  "united kingdom", "india", "east"],
    "products": ["apache license", "gnu general public", "mit license", "linux",
                 "android", "iphone", "heater"],
}

STOP_WORDS = ("about after again against because before being between could during "
              "every further other should their there these those through under until "
              "where which while would")


def words(*texts: str) -> list[str]:
    return sorted({word for text in texts for word in text.split()})


POSITIVE = words(*POSITIVE_EMOTIONS.values())
NEGATIVE = words(*NEGATIVE_EMOTIONS.values())
TOPIC_WORDS = {category: words(*subs.values()) for category, subs in TOPICS.items()}
