"""The default vocabulary of the URL filters: plain words by theme.

Strict terms say by themselves what a site is for.  Soft terms are common on unwanted sites and rare on others; a weight of 1.5 is for
words that seldom mean anything else, 1 for the usual ones, 0.5 for everyday words that count only beside others.  English
plurals are made by rule.  Other vocabularies are given as a table (``url_filter.vocabulary``).
"""

from __future__ import annotations

_STRICT = {
    "adult": "porn porno pornstar xxx hentai milf camgirl camsex sexcam sexchat sextube nsfw escort callgirl fetish bdsm",
    "gambling": "casino jackpot sportsbook bookmaker roulette blackjack slotmachine bets baccarat",
    "medicine": "viagra cialis levitra tramadol xanax phentermine modafinil pills",
    "piracy": "warez keygen crackz nulled freeload",
    "fraud": "phishing malware spyware ransomware spam spammer payday ponzi carding",
}
_SOFT = {
    1.5: "poker lottery betting wager torrent sexy dating hookup lingerie erotic nude bitcoin forex replica counterfeit clickbait backlink linkfarm doorway",
    1.0: "free cheap win winner bonus adult loan coupon promo deal discount ads ad track tracker click farm spin slot credit debt mortgage refinance dose pharmacy prescription steroid weightloss keto crypto airdrop giveaway prize reward serial crack cracked hack cheat download stream mp3 ringtone wallpaper survey popup popunder affiliate referral seo",
    0.5: "best top buy sale offer online now hot easy fast cash money rich earn gift vip girl single chat cam video movie live bet game play link traffic rank review shop store outlet",
}


def _plural(term: str) -> str:
    return term if term.endswith("s") or term[-1].isdigit() else f"{term}s"


STRICT: tuple[str, ...] = tuple(dict.fromkeys(x for words in _STRICT.values() for w in words.split() for x in (w, _plural(w))))
SOFT: dict[str, float] = {x: weight for weight, words in _SOFT.items() for w in words.split() for x in (w, _plural(w)) if x not in STRICT}
