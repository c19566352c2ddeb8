"""Default column names. Every operator takes others as arguments."""

# The grade column and the eleven measurements. The order of the list is the order of
# the feature vector, so position i names feature i of a model; it is not the order in the CSV file.
TARGET = "quality"
FEATURES = [
    "alcohol",
    "sulphates",
    "pH",
    "density",
    "free sulfur dioxide",
    "total sulfur dioxide",
    "chlorides",
    "residual sugar",
    "citric acid",
    "volatile acidity",
    "fixed acidity",
]

LABEL = "label"
VECTOR = "features"
PREDICTION = "prediction"
