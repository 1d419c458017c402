"""The dictionary of analysis techniques, and their detection in sentences with sequence data near."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.strategies import in_context

#: Techniques by their own name, white space or a hyphen for a hyphen; "(s)" is an optional plural.
PLAIN = """
presence-absence; Bray-Curtis; Jaccard; Euclidean; Aitchison; weighted UniFrac; unweighted UniFrac; Canberra; Morisita-Horn; UMAP; correspondence analysis;
partial RDA; variation partitioning; k-means; k-medoids; DBSCAN; Gaussian mixture model; Dirichlet multinomial mixture; spectral clustering; community detection;
ANOSIM; PERMDISP; partial Mantel test(s); Procrustes analysis; PROTEST; MRPP; DESeq2; edgeR; ALDEx2; LEfSe; indicator species analysis; SIMPER; SparCC; FlashWeave; CoNet;
CCLasso; WGCNA; proportionality analysis; mutual information network; co-occurrence network; correlation network; graphical lasso; probabilistic graphical model;
linear regression; multiple linear regression; logistic regression; mixed-effects model(s); zero-inflated model(s); hurdle model(s); negative binomial regression;
Poisson regression; random forest(s); XGBoost; LightGBM; CatBoost; support vector machine(s); decision tree(s); extra tree(s); AdaBoost; elastic net; LASSO; ridge regression;
partial least squares regression; multilayer perceptron; LSTM; autoencoder; variational autoencoder; sequence embedding(s); protein language model(s); DNA language model(s);
spatial autocorrelation; distance-decay analysis; spatial interpolation; kriging; species distribution model(s); geographically weighted regression;
spatial eigenvector mapping; dbMEM; time-series analysis; cross-correlation; autocorrelation analysis; seasonal decomposition; change-point analysis; dynamic time warping;
autoregressive model(s); rarefaction curve(s)
"""

_COMMUNITY = r"ordination|community|taxonomic|otu|asv|abundance|variation"
_MODEL = r"model|regression|abundance|community|taxonomic"
_SPLINE = r"model|spline|mgcv|regression|abundance|community"
_NETWORK = r"neural|network|model|deep|classifier"

#: Techniques with other spellings, each a pattern and, for names that mean other things too, what the
#: neighbourhood must hold.
SPELLED = {
    "Hellinger": (r"hellinger(?:[-\s]+transform(?:ed|ation)?)?", None),
    "CLR": (r"cent(?:e|re)red\s+log[-\s]?ratio|clr[-\s]+transform(?:ed|ation)?|clr[-\s]+(?:abundance|data|counts?)", None),
    "ALR": (r"additive\s+log[-\s]?ratio|alr[-\s]+transform(?:ed|ation)?", None),
    "ILR": (r"isometric\s+log[-\s]?ratio|ilr[-\s]+transform(?:ed|ation)?", None),
    "log1p transformation": (r"log1p(?:[-\s]+transform(?:ed|ation)?)?", None),
    "log transformation": (r"log(?:arithmic)?[-\s]+transform(?:ed|ation)?", None),
    "relative abundance": (r"relative\s+abundance|percentage\s+relative\s+abundance|proportions?", None),
    "total-sum scaling": (r"total[-\s]+sum\s+scal(?:ing|ed)|tss[-\s]+normalization", None),
    "CPM": (r"counts\s+per\s+million|cpm[-\s]+normaliz(?:ed|ation)|cpm[-\s]+counts?", None),
    "CSS": (r"cumulative\s+sum\s+scal(?:ing|ed)|css[-\s]+normaliz(?:ed|ation)", None),
    "TMM": (r"trimmed\s+mean\s+of\s+m[-\s]+values|tmm[-\s]+normaliz(?:ed|ation)", None),
    "RLE": (r"relative\s+log\s+expression|rle[-\s]+normaliz(?:ed|ation)", None),
    "rarefaction": (r"raref(?:ied|action|ying)", None),
    "z-score standardization": (r"z[-\s]?score(?:d)?|standardi[sz]ed", None),
    "PCA": (r"principal\s+component\s+analysis|pca", None),
    "PCoA": (r"principal\s+coordinates?\s+analysis|pcoa", None),
    "NMDS": (r"non[-\s]+metric\s+multidimensional\s+scaling|nmds", None),
    "NMF": (r"non[-\s]+negative\s+matrix\s+factorization|nmf", None),
    "t-SNE": (r"t[-\s]?sne|t[-\s]+distributed\s+stochastic\s+neighbor\s+embedding", None),
    "MDS": (r"multidimensional\s+scaling", None),
    "DCA": (r"detrended\s+correspondence\s+analysis|dca", r"ordination|correspondence|community|taxonomic|otu|asv"),
    "MCA": (r"multiple\s+correspondence\s+analysis", None),
    "PLS-DA": (r"partial\s+least\s+squares\s+discriminant\s+analysis|pls[-\s]?da", None),
    "PLS": (r"partial\s+least\s+squares", None),
    "RDA": (r"redundancy\s+analysis|rda", _COMMUNITY),
    "dbRDA": (r"dbrda|distance[-\s]+based\s+redundancy\s+analysis", None),
    "canonical correspondence analysis": (r"canonical\s+correspondence\s+analysis", None),
    "CAP": (r"canonical\s+analysis\s+of\s+principal\s+coordinates", None),
    "partial CCA": (r"partial\s+canonical\s+correspondence\s+analysis", None),
    "hierarchical clustering": (r"hierarchical\s+cluster(?:ing|ed)?", None),
    "PAM": (r"partitioning\s+around\s+medoids|pam", r"cluster|medoids|community|abundance"),
    "Ward clustering": (r"ward(?:'s)?\s+cluster(?:ing)?", None),
    "observed richness": (r"observed\s+(?:richness|otus?|asvs?|features?)", None),
    "Shannon": (r"shannon(?:\s+(?:diversity|index))?", None),
    "Simpson": (r"simpson(?:\s+(?:diversity|index))?", None),
    "Pielou": (r"pielou(?:'s)?(?:\s+evenness)?", None),
    "Chao1": (r"chao\s*1", None),
    "ACE": (r"ace\s+(?:richness|estimator|index)|abundance[-\s]+based\s+coverage\s+estimator", None),
    "Faith phylogenetic diversity": (r"faith(?:'s)?\s+phylogenetic\s+diversity", None),
    "Hill numbers": (r"hill\s+numbers?", None),
    "PERMANOVA": (r"permutational\s+multivariate\s+analysis\s+of\s+variance|permanova", None),
    "Mantel test": (r"(?<!partial\s)mantel\s+tests?", None),
    "ANCOM-BC": (r"ancom[-\s]?bc", None),
    "ANCOM": (r"ancom(?![-\s]?bc)", None),
    "MaAsLin": (r"maaslin(?:2)?", None),
    "Pearson correlation": (r"pearson(?:'s)?\s+correlation", None),
    "Spearman correlation": (r"spearman(?:'s)?\s+(?:rank\s+)?correlation", None),
    "SPIEC-EASI": (r"spiec[-\s]?easi", None),
    "generalized linear mixed model": (r"generali[zs]ed\s+linear\s+mixed\s+models?|glmm", _MODEL),
    "generalized additive mixed model": (r"generali[zs]ed\s+additive\s+mixed\s+models?|gamm", _SPLINE),
    "generalized linear model": (r"generali[zs]ed\s+linear\s+models?|glm", _MODEL),
    "generalized additive model": (r"generali[zs]ed\s+additive\s+models?|gam", _SPLINE + "|predict"),
    "gradient boosting": (r"gradient\s+boosting|gradient\s+boosted\s+trees?|gradient\s+boosting\s+machine", None),
    "k-nearest neighbors": (r"k[-\s]+nearest\s+neighbou?rs?", None),
    "Gaussian process": (r"gaussian\s+process(?:es)?", None),
    "naive Bayes": (r"na[iï]ve\s+bayes", None),
    "artificial neural network": (r"artificial\s+neural\s+network|ann", r"neural|network|model|classifier"),
    "CNN": (r"convolutional\s+neural\s+network|cnn", _NETWORK),
    "RNN": (r"recurrent\s+neural\s+network|rnn", _NETWORK),
    "transformer": (r"transformer(?:\s+model)?", None),
    "graph neural network": (r"graph\s+neural\s+network|gnn", _NETWORK),
    "Moran's I": (r"moran(?:'s)?\s+i", None),
    "MEM": (r"moran(?:'s)?\s+eigenvector\s+maps?|mem\s+spatial\s+variables?", None),
}

#: Which sections and neighbourhoods are read.
METHODS = r"(?i)\b(?:methods?|materials?\s+and\s+methods?|methodology|experimental\s+(?:procedures?|design)|sample\s+(?:collection|preparation)|sampling|dna\s+extraction|rna\s+extraction|molecular\s+methods?|statistical\s+(?:analysis|methods?)|data\s+analys(?:is|es)|bioinformatics?|community\s+analysis|multivariate\s+analysis|machine\s+learning|supplementary\s+methods?)\b"
NOT_METHODS = r"(?i)\b(?:abstract|introduction|background|results?|discussion|conclusions?|references?|bibliography)\b"
SEQUENCES = r"(?i)\b(?:otus?|asvs?|amplicon\s+sequence\s+variants?|sequence\s+variants?|taxonomic\s+(?:abundance|composition|profiles?|table|matrix)|taxa\s+abundance|relative\s+abundance|abundance\s+(?:table|matrix|data)|feature\s+table|biom\s+table|community\s+(?:matrix|composition|structure|profiles?|data)|microbial\s+communities|microbiome|metabarcod|metagenom|gene\s+abundance|functional\s+abundance|sequence-derived|sequencing\s+data|reads?)\b"
ENVIRONMENT = r"(?i)\b(?:environmental|physicochemical|physico-chemical|chemistry|nutrients?|temperature|salinity|oxygen|ph|chlorophyll)\s+(?:variables?|parameters?|measurements?|data)\b"
MOLECULAR = r"(?i)\b(?:otu|asv|taxonomic|community|microbi|sequence|gene\s+abundance|abundance)\b"


def dictionary() -> dict[str, tuple[str, str | None]]:
    """Every technique's pattern and needed context, on word boundaries and case aside."""
    out = {}
    for name in (x.strip() for x in PLAIN.split(";")):
        body = re.escape(name.removesuffix("(s)")).replace(r"\ ", r"\s+").replace(r"\-", r"[-\s]+") + "s?" * name.endswith("(s)")
        out[name.removesuffix("(s)")] = (rf"\b{body}\b", None)
    return out | {k: (rf"\b(?:{p})\b", c and rf"\b(?:{c})\b") for k, (p, c) in SPELLED.items()}


def is_methods(title: Column) -> Column:
    return title.rlike(METHODS) & ~title.rlike(NOT_METHODS)


def named_in(sentence: Column, window: Column, names: dict[str, tuple[str, str | None]] | None = None) -> Column:
    """array<string>: the techniques that a sentence names, in order; where names overlap, the first and then the longest
    counts. An Arrow-batched function: no built-in gives the places of all matches."""
    known = [(k, re.compile(p, re.I), c and re.compile(c, re.I)) for k, (p, c) in (names or dictionary()).items()]

    def of(s: str, w: str) -> list[str]:
        spans = [(m.start(), -m.end(), k) for k, p, c in known if not c or c.search(w) for m in p.finditer(s)]
        out, end = [], 0
        for start, stop, k in sorted(spans, key=lambda x: x[:2]):
            if start >= end:
                out.append(k)
                end = -stop
        return out

    @F.arrow_udf("array<string>")
    def run(sentences: pa.Array, windows: pa.Array) -> pa.Array:
        return pa.array([of(s or "", w or "") for s, w in zip(sentences.to_pylist(), windows.to_pylist(), strict=True)], pa.list_(pa.string()))

    return run(sentence, window)


def techniques(sentences: DataFrame, key: str, title: Column, names: dict[str, tuple[str, str | None]] | None = None) -> DataFrame:
    """(key, technique, pos): the first sentence of each technique in methods sections, read where sequence data are near.
    The sections and neighbourhoods are told by built-in patterns, so few sentences reach the dictionary."""
    near = in_context(sentences.where(is_methods(title)), key, SEQUENCES, ENVIRONMENT, MOLECULAR)
    each = near.select(key, "pos", F.explode(named_in(F.col("sentence"), F.col("window"), names)).alias("technique"))
    return each.groupBy(key, "technique").agg(F.min("pos").alias("pos"))
