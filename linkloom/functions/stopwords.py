"""The default English stopwords."""

# These 127 words decide which tokens count, so they must stay as they are.
STOPWORDS = tuple(
    """
all just being over both through yourselves its before herself had should to only under
ours has do them his very they not during now him nor did this she each further where
few because doing some are our ourselves out what for while does above between t be we
who were here hers by on about of against s or own into yourself down your from her
their there been whom too themselves was until more himself that but don with than those
he me myself these up will below can theirs my and then is am it an as itself at have in
any if again no when same how other which you after most such why a off i yours so the
having once
""".split()
)
