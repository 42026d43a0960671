"""Noise that the driver's tables lack, so that cleaning operators have something to do on both sides."""

#: (what is there, what replaces it)
NOISE = ((". ", ".  \n\n \n\t "), ("tion ", "tion-\n"), ("and ", "“and” — "))

#: (what is there, marred text that replaces it, what line normalisation makes of that)
MARRED = ((" of ", " don`t &eacute;t&eacute; ", " don't été "), ("ting ", "ﬁn① ｗ ", "fin1 w "), ("que ", "que e\u0301 &#8217; \u00a0", "que é ' "), ("und ", "a‐b “c” — ", "a-b \"c\" – "))
