"""casewise: call-record cleaning, labelling, process mining and answer checks on Spark."""
