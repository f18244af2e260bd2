"""Fixed values.

Everything in this module must keep exactly these values for results to agree with the
original job: the stopword list (one entry per line, in its natural order; the entry
``ours\tourselves`` really holds a tab, so neither ``ours`` nor ``ourselves`` is a stopword),
the label names, the markup pattern, the class-probability smoothing constant, the reject
threshold and the feature sizes.
"""

# --- fixed values: stopwords (173 entries, natural order) -----------------------------
_STOPWORDS_TEXT = """\
a
about
above
after
again
against
all
am
an
and
any
are
aren't
as
at
be
because
been
before
being
below
between
both
but
by
can't
cannot
could
couldn't
did
didn't
do
does
doesn't
doing
don't
down
during
each
few
for
from
further
had
hadn't
has
hasn't
have
haven't
having
he
he'd
he'll
he's
her
here
here's
hers
herself
him
himself
his
how
how's
i
i'd
i'll
i'm
i've
if
in
into
is
isn't
it
it's
its
itself
let's
me
more
most
mustn't
my
myself
no
nor
not
of
off
on
once
only
or
other
ought
our
ours\tourselves
out
over
own
same
shan't
she
she'd
she'll
she's
should
shouldn't
so
some
such
than
that
that's
the
their
theirs
them
themselves
then
there
there's
these
they
they'd
they'll
they're
they've
this
those
through
to
too
under
until
up
very
was
wasn't
we
we'd
we'll
we're
we've
were
weren't
what
what's
when
when's
where
where's
which
while
who
who's
whom
why
why's
with
won't
would
wouldn't
you
you'd
you'll
you're
you've
your
yours
yourself
yourselves"""

STOPWORDS: tuple[str, ...] = tuple(
    line.replace("\\t", "\t") for line in _STOPWORDS_TEXT.split("\n")
)

# --- fixed values: label number -> event name; any other number -> DEFAULT_LABEL_NAME ---
LABEL_NAMES: dict[float, str] = {
    1.0: "ChinaFactoryExplosion",
    2.0: "KentuckyAccidentalChildShooting",
    3.0: "ManhattanBuildingExplosion",
    4.0: "NewtownSchoolShooting",
    5.0: "HurricaneSandy",
    6.0: "HurricaneArthur",
    7.0: "HurricaneIsaac",
    8.0: "TexasFertilizerExplosion",
    9.0: "NewYorkFirefighterShooting",
    10.0: "QuebecTrainDerailment",
    11.0: "FairdaleTornado",
    12.0: "OklahomaTornado",
    13.0: "MississippiTornado",
    14.0: "AlabamaTornado",
}
DEFAULT_LABEL_NAME = "CouldNotClassify"

# --- fixed values: markup pattern (Java regex; removes every tag except anchors) --------
MARKUP_PATTERN_JAVA = r"<(?!\/?a(?=>|\s.*>))\/?.*?>"

# --- fixed values: numbers -------------------------------------------------------------
WCP_VOCABULARY_SIZE = 5000        # V in (1 + n) / (V + tokens_in_class)
REJECT_THRESHOLD = 0.25           # reject option / confident-error threshold
HASH_TF_BUCKETS = 64              # term-frequency buckets (2^6)
CHAR_TF_BUCKETS = 160             # character-level term-frequency buckets
PAD_LENGTH = 70                   # padded feature-array length
KEYWORDS = ("issac", "hurricane", "weather")   # keyword-flag features, in this order
W2V_VECTOR_SIZE = 100
W2V_MIN_COUNT = 5
LR_TOLERANCE = 0.01
LR_MAX_ITER = 100
FP_MIN_SUPPORT = 0.3
FP_NUM_PARTITIONS = 10
DEFAULT_BATCH_ROWS = 50           # rows per pull of the collection scorer
MISSING_LABEL_SENTINEL = 9999999999.0

# --- fixed values: keyed-store names ---------------------------------------------------
COLLECTION_FAMILY = "tweet"
COLLECTION_QUALIFIER = "cleantext"
LABEL_FAMILY = "clean-tweet"
LABEL_QUALIFIER = "real-world-events"
TRAINING_FAMILY = "training-tweet"
TRAINING_LABEL_QUALIFIER = "label"
TRAINING_TEXT_QUALIFIER = "text"
