"""Character classes shared by the text functions.

Regex short-hands such as ``\\s`` mean different things in Java, RE2 and Python, so every class
is spelled out. The values below are fixed: results depend on each of them.
"""

# The 29 characters that count as white space.
WHITE = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

# The same characters as one string, for character-wise replacement.
WHITE_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Characters that count as digits besides the decimal ones (superscripts, circled digits, ...), as
# ranges of code points.
DIGIT_LIKE_RANGES = [
    (0xB2, 0xB3), (0xB9, 0xB9), (0x1369, 0x1371), (0x19DA, 0x19DA), (0x2070, 0x2070),
    (0x2074, 0x2079), (0x2080, 0x2089), (0x2460, 0x2468), (0x2474, 0x247C), (0x2488, 0x2490),
    (0x24EA, 0x24EA), (0x24F5, 0x24FD), (0x24FF, 0x24FF), (0x2776, 0x277E), (0x2780, 0x2788),
    (0x278A, 0x2792), (0x10A40, 0x10A43), (0x10E60, 0x10E68), (0x11052, 0x1105A),
    (0x1F100, 0x1F10A),
]
DIGIT_LIKE_CHARACTERS = "".join(
    chr(point) for first, last in DIGIT_LIKE_RANGES for point in range(first, last + 1))

# The 32 ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
